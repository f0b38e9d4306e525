"""Reports on stored sums against the same reports on the raw tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from accountloom.operators import with_ingestion_date
from accountloom.plans import daily, dashboard, sums
from accountloom.queries import Layers, verify_counts
from accountloom.schemas import ENTITIES
from accountloom.sources import warehouse
from tests.support import TESTDATA, plan, rows

DAYS = [dt.date(2025, 1, d) for d in (1, 2, 3)]
READS = {name: entity for name, (entity, _) in dashboard.REPORTS.items()}


@pytest.fixture(scope="module")
def layers(spark):
    return Layers(spark, TESTDATA)


def load(layers, database, day, share=1.0, reload=False):
    # Whole amounts, so that the order of addition does not show.
    frames = {e: with_ingestion_date(layers.raw[e], day) for e in ENTITIES}
    frames["deals"] = frames["deals"].withColumn("deal_value", F.floor("deal_value").cast("double"))
    frames["subscriptions"] = frames["subscriptions"].withColumn("mrr", F.floor("mrr").cast("double"))
    frames = {e: df.filter(F.pmod(F.xxhash64(*df.columns), F.lit(100)) < 100 * share) for e, df in frames.items()}
    if reload:
        warehouse.reload_raw(frames, database, day)
    else:
        warehouse.append_raw(frames, database)


def check(spark, database, as_of):
    sums.create_views(spark, database)
    sums.create_functions(spark, database)
    raw = daily.raw_layer(spark, database)
    spark.sql(f"USE {database}")
    try:
        for name, entity in READS.items():
            extra = (as_of,) if name == "pipeline_health_check" else ()
            until = raw[entity].filter(F.col("ingestion_date") <= F.lit(as_of))
            wanted = getattr(dashboard, name)(until, *extra)
            assert rows(spark.sql(f"SELECT * FROM {name}_on(DATE '{as_of}')")) == rows(wanted), name
            if not extra:
                assert rows(spark.table(f"{database}.{name}")) == rows(getattr(dashboard, name)(raw[entity])), name
    finally:
        spark.sql("USE default")


def test_sums_follow_appends_reloads_and_retention(spark, database, layers):
    warehouse.create_raw_tables(spark, database)
    warehouse.create_core_tables(spark, database)
    load(layers, database, DAYS[0])
    sums.refresh(spark, database, DAYS[0])
    check(spark, database, DAYS[0])
    load(layers, database, DAYS[1], 0.5)
    load(layers, database, DAYS[1], 0.3)
    sums.refresh(spark, database, DAYS[1])
    check(spark, database, DAYS[1])
    check(spark, database, DAYS[0])
    load(layers, database, DAYS[1], 0.7, reload=True)
    for _ in range(2):
        sums.refresh(spark, database, DAYS[1])
    check(spark, database, DAYS[2])
    daily.drop_expired(spark, f"{database}-none", database, dt.date(2025, 1, 31), 30)
    assert {r[0] for r in spark.table(f"{database}.sums_deals").select("ingestion_date").collect()} == {DAYS[1]}
    check(spark, database, DAYS[2])
    sums.refresh(spark, database)
    check(spark, database, DAYS[2])


def test_no_value_and_no_number(spark, database):
    warehouse.create_raw_tables(spark, database)
    deals = spark.createDataFrame(
        [(1, 1, None, "a"), (2, 1, 5.0, "b"), (3, 1, float("nan"), "b"), (4, 1, 2.0, None)],
        "deal_id long, customer_id long, deal_value double, deal_stage string",
    ).selectExpr("*", "CAST(NULL AS date) AS close_date", "'o' AS owner")
    warehouse.append_raw({"deals": with_ingestion_date(deals, DAYS[0])}, database)
    sums.refresh(spark, database, DAYS[0])
    sums.create_views(spark, database)
    found = {r.deal_stage: (r.deal_count, str(r.total_value), str(r.avg_value)) for r in spark.table(f"{database}.deal_distribution_by_stage").collect()}
    assert found == {"a": (1, "None", "None"), "b": (2, "nan", "nan"), None: (1, "2.0", "2.0")}


def test_reports_read_no_raw_table(spark, database, layers):
    warehouse.create_raw_tables(spark, database)
    sums.create_views(spark, database)
    for name in READS:
        text = plan(spark.table(f"{database}.{name}"), "simple")
        assert "raw_" not in text and f"{database}.sums_" in text


def test_a_function_of_a_day_reads_its_days_only(spark, database):
    sums.create_functions(spark, database)
    spark.sql(f"USE {database}")
    text = plan(spark.sql("SELECT * FROM pipeline_health_check_on(DATE '2025-01-10')"))
    spark.sql("USE default")
    assert ">= 2025-01-03" in text and "<= 2025-01-10" in text and "PartitionFilters" in text


def test_counts_come_from_footers(spark, database, layers):
    text = plan(verify_counts(layers))
    assert text.count("PushedAggregation: [COUNT(*)]") == 2
    warehouse.create_raw_tables(spark, database)
    warehouse.create_core_tables(spark, database)
    names = ["raw_deals", "fact_deals"]
    assert [tuple(r) for r in warehouse.row_counts(spark, database, names).collect()] == [(n, 0) for n in names]
    warehouse.append_raw({"deals": layers.raw["deals"]}, database)
    for _ in range(2):
        warehouse.reload_raw({"deals": layers.raw["deals"]}, database, DAYS[0])
    assert warehouse.row_counts(spark, database, names[:1]).first().row_count == layers.raw["deals"].count()
