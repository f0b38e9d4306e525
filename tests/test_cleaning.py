from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from accountloom.operators import first_per_key, surviving_ids
from accountloom.plans import cleaning, core, staging
from accountloom.schemas import raw_columns
from tests.support import rows, source

DAY = "2025-01-01"


def customer(id, email, **more):
    return {"customer_id": id, "email": email, **more}


def test_lowest_id_of_an_email_stays(spark):
    src = source(
        spark, "customers", customer("9", "a@x"), customer("3", " A@X "), customer("5", "a@x")
    )
    assert [r.customer_id for r in cleaning.clean_customers(src, DAY).collect()] == [3]


def test_an_unparsed_id_displaces_its_email_until_staging_drops_it(spark):
    src = source(spark, "customers", customer("3", "a@x"), customer("X4", "a@x"))
    cleaned = cleaning.clean_customers(src, DAY)
    assert [r.customer_id for r in cleaned.collect()] == [None]
    assert staging.stage_customers(cleaned).count() == 0


def test_all_null_emails_are_one_row(spark):
    src = source(spark, "customers", *[customer(str(i), None) for i in range(5, 0, -1)])
    cleaned = cleaning.clean_customers(src, DAY)
    assert [r.customer_id for r in cleaned.collect()] == [1]
    assert staging.stage_customers(cleaned).count() == 0


def test_ties_are_decided_by_the_other_columns(spark):
    records = [customer("1", "a@x", name=n) for n in ("d", "b", "c")]
    for seed in range(3):
        random.Random(seed).shuffle(records)
        src = source(spark, "customers", *records).repartition(3)
        assert [r.name for r in cleaning.clean_customers(src, DAY).collect()] == ["b"]


@pytest.mark.parametrize("seed", range(4))
def test_surviving_ids_equal_the_ids_of_the_kept_rows(spark, seed):
    rnd = random.Random(seed)
    data = [
        (rnd.choice([None, "a", "b", "c", "d", "e"]), rnd.choice([None, *range(1, 9)]), i)
        for i in range(rnd.choice([1, 10, 40]))
    ]
    df = spark.createDataFrame(data, "email string, id int, other int")
    kept = first_per_key(df, "email", "id").filter("id IS NOT NULL").select("id")
    assert rows(surviving_ids(df, "email", "id")) == rows(kept)


def test_contacts_multiply_with_a_repeated_customer_id(spark):
    customers = source(spark, "customers", customer("1", "a@x"), customer("1", "b@x"))
    contacts = source(
        spark,
        "contacts",
        {"contact_id": "10", "customer_id": "1"},
        {"contact_id": "11", "customer_id": "10001"},
        {"contact_id": "12", "customer_id": "bad"},
    )
    ids = cleaning.customer_ids(customers)
    inner = cleaning.clean_contacts(contacts, ids, DAY)
    assert inner.columns[0] == "customer_id"
    assert [r.contact_id for r in inner.collect()] == [10, 10]
    once = cleaning.clean_contacts_once(contacts, ids, DAY)
    assert [r.contact_id for r in once.collect()] == [10]


def test_bad_values_become_null_and_rows_stay(spark):
    deals = source(
        spark,
        "deals",
        {"deal_id": "1", "customer_id": "7", "deal_value": "n/a", "close_date": "soon"},
        {"deal_id": "x", "customer_id": "7", "deal_value": "10.5", "close_date": "01/31/2024"},
    )
    cleaned = cleaning.clean_deals(deals, DAY).orderBy(F.asc_nulls_last("deal_id")).collect()
    assert [(r.deal_id, r.deal_value, r.close_date) for r in cleaned] == [
        (1, None, None),
        (None, 10.5, dt.date(2024, 1, 31)),
    ]
    assert {r.ingestion_date for r in cleaned} == {dt.date(2025, 1, 1)}


def test_deals_of_unknown_customers_are_kept(spark):
    deals = source(spark, "deals", {"deal_id": "1", "customer_id": "404", "deal_value": "1"})
    assert cleaning.clean_deals(deals, DAY).count() == 1


def test_cleaned_types(spark):
    sources = {e: source(spark, e, {}) for e in raw_columns_by_entity()}
    cleaned = cleaning.clean_all(sources, DAY)
    types = {
        e: {f.name: f.dataType.simpleString() for f in df.schema.fields}
        for e, df in cleaned.items()
    }
    for entity, columns in raw_columns_by_entity().items():
        assert set(types[entity]) == set(columns)
        for name, kind in types[entity].items():
            if name.endswith("_id"):
                assert kind == "bigint"
            elif name in ("deal_value", "mrr"):
                assert kind == "double"
            elif name == "timestamp":
                assert kind == "timestamp"
            elif name.endswith("_date"):
                assert kind == "date"
            else:
                assert kind == "string"


def raw_columns_by_entity():
    return {e: raw_columns(e) for e in cleaning.CLEANERS} | {"contacts": raw_columns("contacts")}


def test_staging_drops_rows_without_keys_value_or_time(spark):
    raw = cleaning.clean_all(
        {
            "customers": source(spark, "customers", customer("1", "A@x ", plan_tier="FREE")),
            "contacts": source(spark, "contacts", {"contact_id": "q", "customer_id": "1"}),
            "deals": source(
                spark,
                "deals",
                *[
                    {"deal_id": str(i), "customer_id": "1", "deal_value": v, "deal_stage": "Won"}
                    for i, v in enumerate(["0", "-5", "bad", None, "2.345"])
                ],
            ),
            "activities": source(
                spark,
                "activities",
                {"activity_id": "1", "customer_id": "1", "timestamp": "n/a"},
                {"activity_id": "2", "customer_id": "1", "timestamp": "2024-01-01 00:00:00"},
            ),
            "subscriptions": source(
                spark,
                "subscriptions",
                {"subscription_id": "1", "customer_id": "1", "plan": "Free", "status": "Paused"},
                {"subscription_id": "2", "plan": "Free"},
            ),
        },
        DAY,
    )
    staged = staging.stage_all(raw)
    assert [(r.email, r.plan_tier) for r in staged["customers"].collect()] == [("a@x", "free")]
    assert staged["contacts"].count() == 0
    assert [(r.deal_value, r.deal_stage) for r in staged["deals"].collect()] == [(2.35, "won")]
    assert [r.activity_id for r in staged["activities"].collect()] == [2]
    assert [(r.mrr, r.status) for r in staged["subscriptions"].collect()] == [(None, "paused")]
    for entity, df in staged.items():
        assert df.columns == raw_columns(entity)


def test_warehouse_text_rules_in_staging(spark):
    raw = {
        "customers": source(spark, "customers", customer("1", "\ta@x ", company="Smith-jones\t")),
        "contacts": source(
            spark, "contacts", {"contact_id": "1", "customer_id": "1", "email": "B@x\t"}
        ),
    }
    raw = {e: df.withColumn("ingestion_date", F.lit(dt.date(2025, 1, 1))) for e, df in raw.items()}
    plain = staging.stage_customers(raw["customers"]).first()
    assert (plain.email, plain.company) == ("\ta@x", "Smith-jones\t")
    customers = staging.stage_customers(raw["customers"], warehouse_text=True).first()
    assert (customers.email, customers.company) == ("a@x", "Smith-Jones")
    assert staging.stage_contacts(raw["contacts"], warehouse_text=True).first().email == "b@x"


def test_nan_is_no_positive_value(spark):
    deals = source(
        spark, "deals", *[{"deal_id": str(i), "customer_id": "1", "deal_value": v} for i, v in enumerate(["NaN", "1.5", "0", "-1", None, "Infinity"])]
    )
    assert [r.deal_id for r in staging.stage_deals(cleaning.clean_deals(deals, DAY)).collect()] == [1, 5]


def test_narrow_ids_lose_what_wide_ones_keep(spark):
    deals = source(spark, "deals", {"deal_id": "3000000000", "customer_id": "5000000000.0", "deal_value": "1"})
    wide = cleaning.clean_deals(deals, DAY).first()
    assert (wide.deal_id, wide.customer_id) == (3000000000, 5000000000)
    narrow = cleaning.clean_deals(deals, DAY, "int")
    assert dict(narrow.dtypes)["deal_id"] == "int" and narrow.first().deal_id is None


def test_wide_ids_reach_the_core(spark):
    big = 5_000_000_000
    sources = {
        "customers": source(spark, "customers", {"customer_id": str(big), "email": "a@b.c", "plan_tier": "free"}),
        "contacts": source(spark, "contacts", {"contact_id": str(big + 1), "customer_id": str(big)}),
        "deals": source(spark, "deals", {"deal_id": str(big + 2), "customer_id": str(big), "deal_value": "2"}),
        "activities": source(
            spark, "activities",
            *[{"activity_id": str(big + i), "customer_id": str(big), "timestamp": "2024-01-01 00:00:00"} for i in range(3)],
        ),
        "subscriptions": source(spark, "subscriptions", {"subscription_id": str(big + 9), "customer_id": str(big)}),
    }
    models = core.build_core(staging.stage_all(cleaning.clean_all(sources, DAY)), "2025-01-01")
    assert [(r.deal_id, r.plan_tier) for r in models["fact_deals"].collect()] == [(big + 2, "free")]
    assert [(r.customer_id, r.total_activities) for r in models["dim_customers"].collect()] == [(big, 3)]
    assert [r.subscription_id for r in models["dim_subscriptions"].collect()] == [big + 9]
