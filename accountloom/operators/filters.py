"""Row filters shared by the layers."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountloom.functions.dates import days_before, run_date
from accountloom.schemas import DAY


def with_ingestion_date(df: DataFrame, day: dt.date | str) -> DataFrame:
    return df.withColumn(DAY, F.lit(run_date(day)))


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Keep rows in which none of the columns is NULL."""
    return df.filter(reduce(Column.__and__, [F.col(c).isNotNull() for c in columns]))


def positive(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value is above zero. Spark ranks NaN above all numbers; it is none."""
    return df.filter((F.col(column) > 0) & ~F.isnan(column))


def keep_recent(df: DataFrame, as_of=None, days: int = 7) -> DataFrame:
    """Rows ingested since `days` before as_of, that day included, later days too."""
    return df.filter(F.col(DAY) >= days_before(days, as_of))


def retain(df: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """Rows younger than `days`; what has reached that age expires."""
    return df.filter(F.col(DAY) > days_before(days, as_of))


def within_days(df: DataFrame, first: dt.date | str, last: dt.date | str) -> DataFrame:
    """Rows of the days first..last; on a stored table other days are not read."""
    return df.filter(F.col(DAY).between(F.lit(run_date(first)), F.lit(run_date(last))))
