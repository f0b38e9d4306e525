"""The five text sources, derived from the order and event tables of a test set.

The column expressions are fixed values that Spark and the SQL check share; the
few functions whose names differ are filled in per dialect.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Dialect:
    text: str
    format: Callable[[str, str], str]
    plus_days: Callable[[str, str], str]


# Names of the four formats, written for Spark.
ISO, US = "yyyy-MM-dd", "MM/dd/yyyy"
ISO_TIME, US_TIME = "yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy HH:mm"

SPARK = Dialect(
    text="string",
    format=lambda x, form: f"date_format({x}, '{form}')",
    plus_days=lambda d, n: f"date_add({d}, cast({n} as int))",
)

FROM = {
    "customers": "customer JOIN nation ON c_nationkey = n_nationkey",
    "contacts": "orders",
    "deals": "orders",
    "activities": "events",
    "subscriptions": "customer",
}


def source_expressions(entity: str, d: Dialect) -> dict[str, str]:
    """Column name to SQL expression, all of text type."""

    def text(x: str) -> str:
        return f"cast({x} as {d.text})"

    tier = "CASE c_custkey % 4 WHEN 0 THEN 'free' WHEN 1 THEN 'Starter' WHEN 2 THEN 'growth' ELSE 'ENTERPRISE' END"
    signup = d.plus_days("DATE '1998-01-01'", "c_custkey * 7 % 1095")
    renewal = d.plus_days("DATE '2001-01-01'", "c_custkey * 11 % 730")

    if entity == "customers":
        return {
            "customer_id": (
                f"CASE WHEN c_custkey % 500 = 27 THEN concat('X', {text('c_custkey')})"
                f" WHEN c_custkey % 50 = 1 THEN {text('c_custkey + 1')}"
                f" WHEN c_custkey % 50 = 4 THEN concat({text('c_custkey')}, '.0') ELSE {text('c_custkey')} END"
            ),
            "name": "c_name",
            "email": (
                "CASE WHEN c_custkey % 97 = 0 THEN NULL"
                f" WHEN c_custkey % 20 = 7 THEN concat('user', {text('c_custkey - 7')}, '@example.com')"
                f" WHEN c_custkey % 3 = 0 THEN concat('  USER', {text('c_custkey')}, '@Example.COM ')"
                f" ELSE concat('user', {text('c_custkey')}, '@example.com') END"
            ),
            "company": (
                "CASE WHEN c_custkey % 10 < 3 THEN concat(' ', lower(c_mktsegment), ' and-co sons')"
                " WHEN c_custkey % 10 < 5 THEN concat(c_mktsegment, ' AND-CO SONS ')"
                " ELSE concat(c_mktsegment, ' and-co Sons') END"
            ),
            "signup_date": (
                "CASE WHEN c_custkey % 101 = 5 THEN 'unknown'"
                f" WHEN c_custkey % 5 < 2 THEN {d.format(signup, US)} ELSE {d.format(signup, ISO)} END"
            ),
            "plan_tier": tier,
            "country": "n_name",
        }
    if entity == "contacts":
        return {
            "contact_id": text("o_orderkey"),
            "customer_id": f"CASE WHEN o_orderkey % 60 = 5 THEN {text('o_custkey + 10000000')} ELSE {text('o_custkey')} END",
            "first_name": f"concat('First', {text('o_orderkey % 50')})",
            "last_name": f"concat('Last', {text('o_orderkey % 70')})",
            "email": (
                f"CASE WHEN o_orderkey % 3 = 0 THEN concat(' C', {text('o_orderkey')}, '@MAIL.example ')"
                f" ELSE concat('c', {text('o_orderkey')}, '@mail.example') END"
            ),
            "phone": f"CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE concat('555-', {text('o_orderkey % 10000')}) END",
            "role": "CASE WHEN o_orderkey % 50 = 5 THEN NULL ELSE o_orderpriority END",
        }
    if entity == "deals":
        return {
            "deal_id": text("o_orderkey"),
            "customer_id": text("o_custkey"),
            "deal_value": (
                "CASE WHEN o_orderkey % 211 = 3 THEN '0' WHEN o_orderkey % 227 = 3 THEN '-5.00'"
                f" WHEN o_orderkey % 223 = 3 THEN 'n/a'"
                f" WHEN o_orderkey % 4 = 1 THEN concat({text('cast(o_totalprice as decimal(18,2))')}, '4')"
                f" ELSE {text('cast(o_totalprice as decimal(18,2))')} END"
            ),
            "deal_stage": (
                "CASE o_orderkey % 6 WHEN 0 THEN 'prospecting' WHEN 1 THEN 'Qualified' WHEN 2 THEN 'proposal'"
                " WHEN 3 THEN 'negotiation' WHEN 4 THEN 'closed_won' ELSE 'CLOSED_LOST' END"
            ),
            "close_date": (
                "CASE WHEN o_orderkey % 6 < 4 THEN NULL"
                f" WHEN o_orderkey % 5 < 2 THEN {d.format('o_orderdate', US)} ELSE {d.format('o_orderdate', ISO)} END"
            ),
            "owner": f"concat('Rep ', {text('o_orderkey % 25')})",
        }
    if entity == "activities":
        return {
            "activity_id": text("event_id"),
            "customer_id": text("user_id"),
            "activity_type": "CASE WHEN event_id % 2 = 0 THEN upper(event_type) ELSE event_type END",
            "timestamp": (
                "CASE WHEN event_id % 53 = 3 THEN 'n/a'"
                f" WHEN event_id % 5 < 2 THEN {d.format('ts', US_TIME)} ELSE {d.format('ts', ISO_TIME)} END"
            ),
            "outcome": "CASE WHEN event_id % 20 = 9 THEN NULL WHEN event_id % 4 = 0 THEN 'Positive' ELSE 'neutral' END",
            "notes": "CASE WHEN event_id % 10 < 3 THEN NULL ELSE props END",
        }
    return {
        "subscription_id": text("c_custkey"),
        "customer_id": text("c_custkey"),
        "plan": tier,
        "mrr": f"CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE {text('cast(abs(c_acctbal) as decimal(18,2))')} END",
        "renewal_date": f"CASE WHEN c_custkey % 5 < 2 THEN {d.format(renewal, US)} ELSE {d.format(renewal, ISO)} END",
        "status": "CASE c_custkey % 5 WHEN 3 THEN 'churned' WHEN 4 THEN 'Paused' ELSE 'active' END",
    }


def derive_source(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    if entity == "customers":
        # The nation table is a fixed list of countries.
        rows = table("customer").join(
            F.broadcast(table("nation")), F.col("c_nationkey") == F.col("n_nationkey")
        )
    else:
        rows = table(FROM[entity])
    columns = source_expressions(entity, SPARK)
    return rows.select([F.expr(x).alias(c) for c, x in columns.items()])
