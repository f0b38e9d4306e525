from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from accountloom.operators import with_ingestion_date
from accountloom.plans import core
from accountloom.schemas import CORE_COLUMNS
from tests.support import rows

DAYS = ["2025-01-01", "2025-01-02"]


def staged(spark, seed=0, size=40, ids=10, days=1, copies=1):
    """Small staging frames: a third of the rows of each on customer 1, ids repeating."""
    rnd = random.Random(seed)

    def id():
        return 1 if rnd.random() < 0.33 else rnd.randrange(ids)

    day = dt.date(2024, 5, 1)
    customers = [
        (id(), f"n{i % 3}", f"e{i}", "Co", day, rnd.choice(["free", "growth"]), "DE")
        for i in range(size // 2)
    ]
    deals = [(i, id(), float(i), "won", None, "rep") for i in range(size)]
    activities = [
        (rnd.randrange(size // 2), id(), "call", dt.datetime(2024, 1, 1 + i % 28), None, None)
        for i in range(size)
    ]
    subscriptions = [
        (i, id(), "growth", rnd.choice([None, 10.0, 20.0]), rnd.choice([None, day]), "active")
        for i in range(size // 2)
    ]
    frames = {
        "customers": spark.createDataFrame(
            customers,
            "customer_id int, name string, email string, company string, signup_date date, "
            "plan_tier string, country string",
        ),
        "deals": spark.createDataFrame(
            deals,
            "deal_id int, customer_id int, deal_value double, deal_stage string, "
            "close_date date, owner string",
        ),
        "activities": spark.createDataFrame(
            activities,
            "activity_id int, customer_id int, activity_type string, timestamp timestamp, "
            "outcome string, notes string",
        ),
        "subscriptions": spark.createDataFrame(
            subscriptions,
            "subscription_id int, customer_id int, plan string, mrr double, renewal_date date, "
            "status string",
        ),
    }
    loaded = {}
    for entity, df in frames.items():
        parts = [with_ingestion_date(df, d) for d in DAYS[:days] for _ in range(copies)]
        loaded[entity] = parts[0]
        for part in parts[1:]:
            loaded[entity] = loaded[entity].unionByName(part)
    return loaded


def grouped_after_joining(s):
    """dim_customers by its definition: join everything, then group by all attributes."""
    c = s["customers"]
    p = s["subscriptions"].select(
        "customer_id", "mrr", F.col("status").alias("subscription_status"), "renewal_date"
    )
    a = s["activities"].select("customer_id", "activity_id", "timestamp")
    keys = [*c.columns[:-1], "mrr", "subscription_status", "renewal_date", "ingestion_date"]
    joined = c.join(p, "customer_id", "left").join(a, "customer_id", "left")
    return (
        joined.groupBy(*keys)
        .agg(
            F.count_distinct("activity_id").alias("total_activities"),
            F.max("timestamp").alias("last_activity_at"),
        )
        .select(CORE_COLUMNS["dim_customers"])
    )


@pytest.mark.parametrize("hot", [1, 5, 1_000_000])
@pytest.mark.parametrize("seed, days, copies", [(0, 1, 1), (1, 2, 1), (2, 1, 2), (3, 2, 2)])
def test_dim_customers_equals_its_definition(spark, seed, days, copies, hot):
    s = staged(spark, seed, days=days, copies=copies)
    ours = core.dim_customers(s["customers"], s["subscriptions"], s["activities"], hot_rows=hot)
    assert rows(ours) == rows(grouped_after_joining(s))


@pytest.mark.parametrize("hot", [1, 1_000_000])
def test_deal_and_subscription_joins_equal_plain_ones(spark, hot):
    s = staged(spark, 4, days=2)
    c = s["customers"]
    fact = core.fact_deals(s["deals"], c, hot_rows=hot)
    plain = s["deals"].join(c.drop("ingestion_date"), "customer_id", "left")
    assert rows(fact) == rows(plain.select(CORE_COLUMNS["fact_deals"]))

    subs = core.dim_subscriptions(s["subscriptions"], c, "2024-04-01", hot_rows=hot)
    plain = (
        s["subscriptions"]
        .join(c.drop("ingestion_date"), "customer_id", "left")
        .withColumn("customer_since", F.col("signup_date"))
        .withColumn("days_until_renewal", F.expr("date_diff(renewal_date, date'2024-04-01')"))
    )
    assert rows(subs) == rows(plain.select(CORE_COLUMNS["dim_subscriptions"]))


@pytest.mark.parametrize("hot", [1, 1_000_000])
def test_chain_keeps_customers_without_plan_or_activity(spark, hot):
    s = staged(spark, 5, size=20, ids=30)
    chain = core.customer_activity_chain(
        s["customers"], s["subscriptions"], s["activities"], hot_rows=hot
    )
    plans = s["subscriptions"].selectExpr(
        "customer_id", "mrr", "status AS subscription_status", "renewal_date"
    )
    events = s["activities"].select("customer_id", "activity_id", "timestamp")
    plain = s["customers"].join(plans, "customer_id", "left").join(events, "customer_id", "left")
    assert rows(chain) == rows(plain.select(chain.columns))


def test_days_join_across_unless_a_snapshot_is_chosen(spark):
    one, two = staged(spark, 6, days=1), staged(spark, 6, days=2)
    across = core.fact_deals(two["deals"], two["customers"])
    single = core.fact_deals(one["deals"], one["customers"])
    matched = F.col("country").isNotNull()
    assert across.filter(matched).count() == 4 * single.filter(matched).count()
    assert across.filter(~matched).count() == 2 * single.filter(~matched).count()
    for model, df in core.build_core(two, "2024-01-01", snapshot=DAYS[0]).items():
        assert rows(df) == rows(core.build_core(one, "2024-01-01")[model])


def test_customer_without_activity_counts_zero(spark):
    s = staged(spark)
    none = s["activities"].limit(0)
    got = core.dim_customers(s["customers"], s["subscriptions"], none)
    assert {(r.total_activities, r.last_activity_at) for r in got.collect()} == {(0, None)}


def test_equal_plans_of_a_customer_collapse(spark):
    s = staged(spark)
    one = s["customers"].limit(1)
    id = one.first().customer_id
    plan = s["subscriptions"].limit(1).withColumns(
        {"customer_id": F.lit(id), "mrr": F.lit(5.0)}
    )
    other = plan.withColumn("mrr", F.lit(6.0))
    got = core.dim_customers(one, plan.unionByName(plan).unionByName(other), s["activities"])
    assert sorted(r.mrr for r in got.collect()) == [5.0, 6.0]


def test_renewal_days_default_to_today(spark):
    s = staged(spark)
    renewing = s["subscriptions"].withColumn("renewal_date", F.current_date())
    got = core.dim_subscriptions(renewing, s["customers"])
    assert {r.days_until_renewal for r in got.collect()} == {0}
