"""Which customers have a deal in a stage, as bitmaps.

A row holds the customers of one stage among 32,768 consecutive ids, one bit each. Sets of
customers are then combined bucket by bucket, and a filter on any set of stages joins
customers to one row per bucket instead of to their deals. Ids of any width and sign have
a bit; ids far apart from each other cost a row of four kilobytes each.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accountloom.operators import require, within_days
from accountloom.plans.dashboard import customer_signups_over_time
from accountloom.schemas import BITMAP_COLUMNS, DAY
from accountloom.sources import warehouse

TABLE = "bitmaps_deals"


def stage_bitmaps(deals: DataFrame, *also: str) -> DataFrame:
    """Rows (also.., deal_stage, bucket, customers). Tasks combine their rows before the shuffle."""
    bit = F.bitmap_construct_agg(F.bitmap_bit_position("customer_id"))
    bucket = F.bitmap_bucket_number("customer_id").alias("bucket")
    known = require(deals, "customer_id")
    return known.groupBy(*also, "deal_stage", bucket).agg(bit.alias("customers"))


def customers_of(bitmaps: DataFrame, any_of: Sequence[str] = (), all_of: Sequence[str] = ()) -> DataFrame:
    """Rows (bucket, customers): those with a deal in one of the stages, or in each of them.

    Given both, customers have to meet both. Rows of one stage and bucket, of several
    days say, count together.
    """
    wanted = [*any_of, *all_of]
    per_stage = (
        bitmaps.filter(F.col("deal_stage").isin(wanted))
        .groupBy("deal_stage", "bucket")
        .agg(F.bitmap_or_agg("customers").alias("customers"))
    )
    sets = []
    if any_of:
        some = per_stage.filter(F.col("deal_stage").isin(list(any_of)))
        sets.append(some.groupBy("bucket").agg(F.bitmap_or_agg("customers").alias("customers")))
    if all_of:
        each = per_stage.filter(F.col("deal_stage").isin(list(all_of)))
        both = each.groupBy("bucket").agg(F.bitmap_and_agg("customers").alias("customers"), F.count(F.lit(1)).alias("n"))
        sets.append(both.filter(F.col("n") == len(set(all_of))).drop("n"))
    if not sets:
        raise ValueError("name at least one stage")
    if len(sets) == 1:
        return sets[0]
    met = sets[0].unionByName(sets[1]).groupBy("bucket")
    return met.agg(F.bitmap_and_agg("customers").alias("customers"), F.count(F.lit(1)).alias("n")).filter("n = 2").drop("n")


def _bit(bits: Column, customer_id: Column) -> Column:
    """Whether the customer's bit is set; false where there is no bitmap."""
    place = F.bitmap_bit_position(customer_id)
    byte = F.conv(F.hex(F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))


def keep_customers(customers: DataFrame, chosen: DataFrame, inside: bool = True) -> DataFrame:
    """Rows whose customer_id is in the set, or is not. A null id is in none."""
    sets = chosen.select(F.col("bucket").alias("_bucket"), F.col("customers").alias("_set"))
    bucketed = customers.withColumn("_bucket", F.bitmap_bucket_number("customer_id"))
    joined = bucketed.join(sets, "_bucket", "inner" if inside else "left")
    hit = _bit(F.col("_set"), F.col("customer_id"))
    return joined.filter(hit if inside else ~hit).select(customers.columns)


def signups_by_stages(
    customers: DataFrame, bitmaps: DataFrame, any_of: Sequence[str] = (), all_of: Sequence[str] = ()
) -> DataFrame:
    """The signups report over customers with deals in one or in all of the stages."""
    return customer_signups_over_time(keep_customers(customers, customers_of(bitmaps, any_of, all_of)))


def create_table(spark: SparkSession, database: str) -> None:
    warehouse.create_table(spark, database, TABLE, BITMAP_COLUMNS)


def refresh(spark: SparkSession, database: str, day: dt.date | str) -> None:
    """Compute a day's bitmaps from the raw deals of that day; they are switched in one step."""
    create_table(spark, database)
    deals = within_days(warehouse.raw_table(spark, database, "deals"), day, day)
    rows = stage_bitmaps(deals, DAY).select(BITMAP_COLUMNS)
    warehouse.replace_day(rows.sortWithinPartitions("deal_stage", "bucket"), database, TABLE, day)


def drop_expired(spark: SparkSession, database: str, as_of: dt.date | str | None, days: int) -> None:
    warehouse.drop_expired_days(spark, database, TABLE, as_of, days)
