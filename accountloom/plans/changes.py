"""Core tables refreshed for the customers that a change of days concerns.

Every core row depends on the rows of one customer, on all stored days. When days have
been loaded, reloaded or dropped, only customers with a row on one of them, before or
after, can have other core rows. These are built anew from all days; the rows of all others
are taken over. The result is what a full refresh gives, without its join of every day
with every day.

Which customers a day has rows of is kept per day in a table of its own, so that a day's
former customers are known when its rows are gone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountloom.functions import days_until, run_date
from accountloom.operators import semi_join, within_days
from accountloom.plans.core import build_core
from accountloom.schemas import CORE_COLUMNS, DAY, KEY_COLUMNS
from accountloom.settings import scratch_folder
from accountloom.sources import warehouse

TABLE = "core_keys"
# The staged tables that core rows are made of.
SOURCES = ("customers", "deals", "activities", "subscriptions")


def _keys(staged: dict[str, DataFrame], days: Sequence[dt.date]) -> DataFrame:
    """Rows (customer_id, day), distinct: whose rows the days hold."""
    parts = [staged[e].filter(F.col(DAY).isin(list(days))).select("customer_id", DAY) for e in SOURCES]
    return reduce(DataFrame.unionByName, parts).distinct()


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def remember(spark: SparkSession, database: str, days: Sequence[dt.date | str] | None = None) -> None:
    """Note the customers of some days, or of all stored ones, after a full refresh."""
    warehouse.create_table(spark, database, TABLE, KEY_COLUMNS)
    staged = {e: spark.table(f"{database}.stg_{e}") for e in SOURCES}
    if days is None:
        parts = [spark.table(f"{database}.{t}").select(DAY) for t in (*(f"raw_{e}" for e in SOURCES), TABLE)]
        days = [r[0] for r in reduce(DataFrame.unionAll, parts).distinct().collect() if r[0] is not None]
    for day in map(run_date, days):
        warehouse.replace_day(_keys(staged, [day]).select(KEY_COLUMNS), database, TABLE, day)


def refresh(
    spark: SparkSession, database: str, days: Sequence[dt.date | str], as_of: dt.date | str | None = None
) -> int:
    """Bring the core tables up to date after the raw rows of the days have changed.

    The staging views must exist. Returns the number of customers concerned. Days to
    renewal count from as_of, also in rows that are taken over. The core tables must have
    been built from all days (and remember() called) or by this function. Days that no raw
    table has any more are included, whether or not they are named.
    """
    warehouse.create_table(spark, database, TABLE, KEY_COLUMNS)
    raw = reduce(DataFrame.unionAll, [warehouse.stored_days(spark, database, f"raw_{e}") for e in SOURCES])
    gone = [r[0] for r in warehouse.stored_days(spark, database, TABLE).exceptAll(raw.distinct()).collect()]
    days = sorted({run_date(d) for d in [*days, *gone]})
    staged = {e: spark.table(f"{database}.stg_{e}") for e in (*SOURCES, "contacts")}
    before = within_days(spark.table(f"{database}.{TABLE}"), days[0], days[-1]).filter(F.col(DAY).isin(days))
    after = _stored(_keys(staged, days), "keys")
    changed = _stored(before.select("customer_id").unionByName(after.select("customer_id")).distinct(), "changed")
    concerned = {e: semi_join(staged[e], changed, "customer_id") for e in SOURCES}
    models = {}
    for model, built in build_core(concerned, as_of).items():
        kept = spark.table(f"{database}.{model}").join(changed, "customer_id", "left_anti")
        if "days_until_renewal" in kept.columns:
            kept = kept.withColumn("days_until_renewal", days_until("renewal_date", as_of))
        models[model] = kept.select(CORE_COLUMNS[model]).unionByName(built.select(CORE_COLUMNS[model]))
    warehouse.replace_core(models, database)
    for day in days:
        warehouse.replace_day(within_days(after, day, day).select(KEY_COLUMNS), database, TABLE, day)
    warehouse.drop_days(spark, database, TABLE, gone)
    return changed.count()
