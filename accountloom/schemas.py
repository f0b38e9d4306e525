"""Columns of every layer. Names, types, order and clustering."""

from __future__ import annotations

from pyspark.sql import types as T

SOURCE_COLUMNS = {
    "customers": ["customer_id", "name", "email", "company", "signup_date", "plan_tier", "country"],
    "contacts": ["contact_id", "customer_id", "first_name", "last_name", "email", "phone", "role"],
    "deals": ["deal_id", "customer_id", "deal_value", "deal_stage", "close_date", "owner"],
    "activities": ["activity_id", "customer_id", "activity_type", "timestamp", "outcome", "notes"],
    "subscriptions": ["subscription_id", "customer_id", "plan", "mrr", "renewal_date", "status"],
}

ENTITIES = tuple(SOURCE_COLUMNS)

DAY = "ingestion_date"

# Column types that are not string, by column name; ids widen to bigint in tables.
_TABLE_TYPES = {
    "customer_id": "bigint",
    "contact_id": "bigint",
    "deal_id": "bigint",
    "activity_id": "bigint",
    "subscription_id": "bigint",
    "deal_value": "double",
    "mrr": "double",
    "signup_date": "date",
    "close_date": "date",
    "renewal_date": "date",
    "customer_since": "date",
    "timestamp": "timestamp",
    "last_activity_at": "timestamp",
    "total_activities": "bigint",
    "days_until_renewal": "int",
    "signup_month": "date",
    "n_rows": "bigint",
    "n_values": "bigint",
    "total": "double",
    "bucket": "bigint",
    "customers": "binary",
    DAY: "date",
}

RAW_CLUSTERING = {
    "customers": ["plan_tier"],
    "contacts": ["customer_id"],
    "deals": ["deal_stage"],
    "activities": ["activity_type"],
    "subscriptions": ["plan", "status"],
}

CORE_COLUMNS = {
    "fact_deals": [
        "deal_id", "customer_id", "deal_value", "deal_stage", "close_date", "owner",
        "plan_tier", "company", "country", DAY,
    ],
    "dim_customers": [
        "customer_id", "name", "email", "company", "signup_date", "plan_tier", "country", "mrr",
        "subscription_status", "renewal_date", "total_activities", "last_activity_at", DAY,
    ],
    "dim_subscriptions": [
        "subscription_id", "customer_id", "plan", "mrr", "renewal_date", "status", "company",
        "country", "customer_since", "days_until_renewal", DAY,
    ],
}

# Partial sums of the raw tables that reports read.
SUM_COLUMNS = {
    "deals": ["deal_stage", "n_rows", "n_values", "total", DAY],
    "customers": ["signup_month", "plan_tier", "n_rows", DAY],
    "subscriptions": ["plan", "status", "n_rows", "n_values", "total", DAY],
}

# Customers with a deal in a stage, a bit each.
BITMAP_COLUMNS = ["deal_stage", "bucket", "customers", DAY]

# The customers that a day has rows of.
KEY_COLUMNS = ["customer_id", DAY]

CORE_CLUSTERING = {
    "fact_deals": ["deal_stage", "plan_tier"],
    "dim_customers": ["plan_tier"],
    "dim_subscriptions": ["plan", "status"],
}


def source_schema(entity: str) -> T.StructType:
    """A source file holds text only; types come with cleaning."""
    return T.StructType([T.StructField(c, T.StringType()) for c in SOURCE_COLUMNS[entity]])


def raw_columns(entity: str) -> list[str]:
    return [*SOURCE_COLUMNS[entity], DAY]


def write_options(columns: list[str], cluster: list[str] = ()) -> dict[str, str]:
    """How a table's files are written.

    Where rows are not ranged by customer, a Bloom filter per row group, as large as its
    values need, lets a read of one customer skip most of them.
    """
    options = {"compression": "zstd"}
    if "customer_id" in columns and list(cluster[:1]) != ["customer_id"]:
        options["parquet.bloom.filter.enabled#customer_id"] = "true"
        options["parquet.bloom.filter.adaptive.enabled"] = "true"
    return options


def table_type(column: str) -> str:
    return _TABLE_TYPES.get(column, "string")


def column_ddl(columns: list[str]) -> str:
    return ", ".join(f"`{c}` {table_type(c)}" for c in columns)
