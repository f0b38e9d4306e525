from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from accountloom.plans import bitmaps
from accountloom.queries import Layers
from accountloom.sources import warehouse
from tests.support import TESTDATA, plan, rows, settings

STAGES = ["won", "lost", "open"]
WIDE = [0, 1, -1, 7, 8, 32767, 32768, 32769, -32768, -32769, 2**31, 2**40 + 3, 2**62 + 1, 2**63 - 1, -(2**63), -(2**63) + 1]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    ids = WIDE + [rng.randrange(100_000) for _ in range(60)] + [rng.randrange(-(2**63), 2**63) for _ in range(40)]
    deals = [(rng.choice([*ids, None]), rng.choice([*STAGES, None])) for _ in range(250)]
    customers = [(i, n % 5) for n, i in enumerate([*ids, *WIDE, None, None, 123_456_789])]
    return (
        spark.createDataFrame(customers, "customer_id long, v int"),
        spark.createDataFrame(deals, "customer_id long, deal_stage string"),
        {s: {i for i, stage in deals if stage == s and i is not None} for s in STAGES},
        customers,
    )


@pytest.mark.parametrize(
    "any_of, all_of", [(["won"], []), (["won", "lost"], []), ([], STAGES), (["won", "open"], ["lost"]), (["none"], []), ([], ["won", "none"])]
)
@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
def test_sets_are_those_of_a_join(spark, tables, any_of, all_of, broadcast):
    customers, deals, has, plain = tables
    some = set().union(*(has.get(s, set()) for s in any_of)) if any_of else None
    each = set.intersection(*(has.get(s, set()) for s in all_of)) if all_of else None
    wanted = some if each is None else each if some is None else some & each
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=broadcast):
        chosen = bitmaps.customers_of(bitmaps.stage_bitmaps(deals), any_of, all_of)
        inside = rows(bitmaps.keep_customers(customers, chosen))
        outside = rows(bitmaps.keep_customers(customers, chosen, inside=False))
    assert sorted(inside.elements()) == sorted(c for c in plain if c[0] in wanted)
    assert sorted(outside.elements(), key=str) == sorted((c for c in plain if c[0] not in wanted), key=str)


def test_no_stage_is_an_error(tables):
    with pytest.raises(ValueError, match="stage"):
        bitmaps.customers_of(bitmaps.stage_bitmaps(tables[1]))


def test_the_filter_reads_no_deals(spark, database):
    layers = Layers(spark, TESTDATA)
    warehouse.create_raw_tables(spark, database)
    warehouse.append_raw({e: layers.raw[e] for e in ("customers", "deals")}, database)
    bitmaps.refresh(spark, database, "2025-01-01")
    customers = warehouse.raw_table(spark, database, "customers")
    found = bitmaps.signups_by_stages(customers, spark.table(f"{database}.{bitmaps.TABLE}"), any_of=["proposal"])
    assert "raw_deals" not in plan(found, "simple") and found.count() > 0


def scanned_rows(df) -> int:
    """Rows that the scans of a frame gave out when it ran."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.mark.parametrize("name, frame", [("raw_deals", "append"), ("fact_deals", "all"), ("fact_deals", "day")])
def test_a_read_of_one_customer_skips_row_groups(spark, database, name, frame):
    """Rows are ranged by stage, so every file spans all customers; filters per row group tell."""
    n = 600_000
    deals = spark.range(n).select(
        F.col("id").alias("deal_id"), F.pmod(F.xxhash64("id"), F.lit(10**12)).alias("customer_id"), F.lit(1.0).alias("deal_value"),
        F.concat(F.lit("stage"), F.col("id") % 6).alias("deal_stage"), F.lit(None).cast("date").alias("close_date"), F.lit("o").alias("owner"),
        F.lit(None).cast("string").alias("plan_tier"), F.lit(None).cast("string").alias("company"), F.lit(None).cast("string").alias("country"),
        F.lit("2025-01-01").cast("date").alias("ingestion_date"),
    )
    one = deals.filter("deal_id = 4711").first().customer_id
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="24"):
        if frame == "append":
            warehouse.create_raw_tables(spark, database)
            warehouse.append_raw({"deals": deals}, database)
        else:
            warehouse.create_core_tables(spark, database)
            warehouse.replace_core({"fact_deals": deals}, database, None if frame == "all" else "2025-01-01")
    table = spark.table(f"{database}.{name}")
    assert table.select(F.input_file_name()).distinct().count() >= 20
    found = table.filter(F.col("customer_id") == one)
    assert scanned_rows(found) < n / 6
    assert found.count() == deals.filter(F.col("customer_id") == one).count()
