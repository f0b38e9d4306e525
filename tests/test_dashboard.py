from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from accountloom.plans import dashboard
from accountloom.operators import retain
from tests.support import rows


@pytest.fixture(scope="module")
def deals(spark):
    return spark.createDataFrame(
        [
            (1, "won", 10.0), (1, "Won", -4.0), (2, "won", None), (2, "won", 0.0),
            (3, None, 5.0), (4, "lost", 7.25),
        ],
        "customer_id int, deal_stage string, deal_value double",
    )


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(
        [
            (1, dt.date(2024, 1, 31), "free", dt.date(2025, 1, 1)),
            (2, dt.date(2024, 1, 1), "free", dt.date(2024, 12, 31)),
            (3, dt.date(2024, 2, 1), "Free", dt.date(2025, 1, 7)),
            (4, None, "free", dt.date(2025, 2, 1)),
            (5, dt.date(2023, 5, 5), "growth", dt.date(2024, 12, 30)),
        ],
        "customer_id int, signup_date date, plan_tier string, ingestion_date date",
    )


def test_spellings_and_worthless_deals_count(deals):
    got = [tuple(r) for r in dashboard.deal_distribution_by_stage(deals).collect()]
    assert got[0] == ("won", 3, 10.0, 5.0)
    assert set(got) == {
        ("won", 3, 10.0, 5.0), ("Won", 1, -4.0, -4.0), (None, 1, 5.0, 5.0), ("lost", 1, 7.25, 7.25)
    }


def test_signups_per_month_and_tier_in_order(customers):
    got = [tuple(r) for r in dashboard.customer_signups_over_time(customers).collect()]
    assert [g[0] for g in got] == sorted(g[0] for g in got)
    assert set(got) == {
        (dt.date(2023, 5, 1), "growth", 1), (dt.date(2024, 1, 1), "free", 2),
        (dt.date(2024, 2, 1), "Free", 1),
    }


def test_revenue_skips_plans_without_any(spark):
    subscriptions = spark.createDataFrame(
        [("a", "on", 1.0), ("a", "on", 2.0), ("a", "off", 9.0), ("b", "on", None)],
        "plan string, status string, mrr double",
    )
    report = dashboard.mrr_by_plan(subscriptions)
    assert [tuple(r) for r in report.collect()] == [
        ("a", "off", 1, 9.0, 9.0), ("a", "on", 2, 3.0, 1.5)
    ]
    assert rows(dashboard.tile_mrr_by_plan(report)) == {("a", 12.0): 1}


def test_health_check_is_inclusive_and_open_ended(customers):
    got = [tuple(r) for r in dashboard.pipeline_health_check(customers, "2025-01-07").collect()]
    assert got == [
        (dt.date(2025, 2, 1), 1), (dt.date(2025, 1, 7), 1), (dt.date(2025, 1, 1), 1),
        (dt.date(2024, 12, 31), 1),
    ]


def test_health_check_moves_with_today(customers):
    today = customers.limit(1).withColumn("ingestion_date", F.current_date())
    assert dashboard.pipeline_health_check(today).count() == 1


def test_retention_drops_what_reached_the_age(customers):
    kept = {r.customer_id for r in retain(customers, "2025-01-30", 30).collect()}
    assert kept == {1, 3, 4}


def test_tiles(customers, deals):
    signups = dashboard.customer_signups_over_time(customers)
    long = dashboard.tile_signups_by_tier(signups)
    assert rows(long) == rows(signups)
    wide = dashboard.tile_signups_wide(signups, ["free", "Free", "growth"])
    assert wide.columns == ["signup_month", "free", "Free", "growth"]
    assert [tuple(r)[1:] for r in wide.collect()] == [
        (None, None, 1), (2, None, None), (None, 1, None)
    ]
    one = dashboard.tile_signups_one_tier(signups, "Free")
    assert [r.new_customers for r in one.collect()] == [1]
    bars = dashboard.tile_deals_by_stage(dashboard.deal_distribution_by_stage(deals))
    assert bars.first().deal_stage == "won"


@pytest.mark.parametrize("hot", [0, 1, 1_000_000])
def test_choosing_a_stage_limits_the_signups(customers, deals, hot):
    got = dashboard.signups_by_stage(customers, deals, "won", hot)
    assert [tuple(r) for r in got.collect()] == [(dt.date(2024, 1, 1), "free", 2)]


def test_no_tier_is_lost(spark):
    day = dt.date(2024, 3, 3)
    people = spark.createDataFrame(
        [(i, day, tier, day) for i, tier in enumerate(["free", "Free", "pro", None, "Starter", "pro"])],
        "customer_id int, signup_date date, plan_tier string, ingestion_date date",
    )
    signups = dashboard.customer_signups_over_time(people)
    month = dt.date(2024, 3, 1)
    assert rows(dashboard.tile_signups_by_tier(signups)) == {
        (month, "free", 1): 1, (month, "Free", 1): 1, (month, "pro", 2): 1, (month, None, 1): 1,
        (month, "Starter", 1): 1,
    }
    for listed in (["free", "Free", "Starter"], ["free", "Free", "Starter", "pro"]):
        with pytest.raises(Exception, match="tier not listed"):
            dashboard.tile_signups_wide(signups, listed).collect()
