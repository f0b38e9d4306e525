"""Raw tables to staging: normalized values, rows without their keys dropped.

Each model is one list of SQL expressions and one condition, for frames and for the
stored views.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from accountloom.functions.text import WORD_OR_DELIMITER
from accountloom.schemas import ENTITIES, raw_columns

# Spark's rules: spaces are trimmed, spaces start a word.
TRIM, CAPITALIZE = "trim({x})", "initcap({x})"
# A warehouse's rules: all whitespace is trimmed, punctuation starts a word as well.
_EDGE = r"[\s\p{Z}]+"
TRIM_WHITESPACE = (
    f"regexp_replace(regexp_replace({{x}}, r'^{_EDGE}', ''), r'{_EDGE}$', '')".replace("{Z}", "{{Z}}")
)
CAPITALIZE_PARTS = (
    "array_join(transform(regexp_extract_all(lower({x}), r'"
    + WORD_OR_DELIMITER.replace("{", "{{").replace("}", "}}")
    + "', 1), p -> concat(upper(substring(p, 1, 1)), substring(p, 2))), '')"
)

# Expressions of the columns that change, and the rows that stay.
_CHANGED = {
    "customers": {
        "email": "lower({trim_email})",
        "company": "{capitalized_company}",
        "plan_tier": "lower(plan_tier)",
    },
    "contacts": {"email": "lower({trim_email})"},
    "deals": {"deal_value": "round(deal_value, 2)", "deal_stage": "lower(deal_stage)"},
    "activities": {"activity_type": "lower(activity_type)", "outcome": "lower(outcome)"},
    "subscriptions": {"plan": "lower(plan)", "status": "lower(status)"},
}
_KEPT = {
    "customers": "customer_id IS NOT NULL AND email IS NOT NULL",
    "contacts": "contact_id IS NOT NULL AND customer_id IS NOT NULL",
    # Spark ranks NaN above all numbers; it is no positive value.
    "deals": "deal_id IS NOT NULL AND customer_id IS NOT NULL AND deal_value > 0 AND NOT isnan(deal_value)",
    "activities": "activity_id IS NOT NULL AND customer_id IS NOT NULL AND timestamp IS NOT NULL",
    "subscriptions": "subscription_id IS NOT NULL AND customer_id IS NOT NULL",
}


def _columns(entity: str, warehouse_text: bool) -> list[str]:
    trim = TRIM_WHITESPACE if warehouse_text else TRIM
    capitalize = CAPITALIZE_PARTS if warehouse_text else CAPITALIZE
    parts = {
        "trim_email": trim.format(x="email"),
        "capitalized_company": capitalize.format(x=trim.format(x="company")),
    }
    changed = _CHANGED[entity]
    return [
        f"{changed[c].format(**parts)} AS `{c}`" if c in changed else f"`{c}`"
        for c in raw_columns(entity)
    ]


def _stage(entity: str, raw: DataFrame, warehouse_text: bool = False) -> DataFrame:
    return raw.filter(_KEPT[entity]).selectExpr(*_columns(entity, warehouse_text))


def stage_customers(raw: DataFrame, warehouse_text: bool = False) -> DataFrame:
    """warehouse_text trims all whitespace and capitalizes after punctuation, too."""
    return _stage("customers", raw, warehouse_text)


def stage_contacts(raw: DataFrame, warehouse_text: bool = False) -> DataFrame:
    return _stage("contacts", raw, warehouse_text)


def stage_deals(raw: DataFrame) -> DataFrame:
    """Deals of positive value; an open deal has no close date."""
    return _stage("deals", raw)


def stage_activities(raw: DataFrame) -> DataFrame:
    return _stage("activities", raw)


def stage_subscriptions(raw: DataFrame) -> DataFrame:
    """A free plan has no recurring revenue; its NULL stays."""
    return _stage("subscriptions", raw)


STAGES = {
    "customers": stage_customers,
    "contacts": stage_contacts,
    "deals": stage_deals,
    "activities": stage_activities,
    "subscriptions": stage_subscriptions,
}


def stage_all(raw: Mapping[str, DataFrame], warehouse_text: bool = False) -> dict[str, DataFrame]:
    return {entity: _stage(entity, raw[entity], warehouse_text) for entity in ENTITIES}


def create_staging_views(spark: SparkSession, database: str, warehouse_text: bool = False) -> None:
    """The staging models as stored views over the raw tables."""
    for entity in ENTITIES:
        columns = ", ".join(_columns(entity, warehouse_text))
        spark.sql(
            f"CREATE OR REPLACE VIEW {database}.stg_{entity} AS "
            f"SELECT {columns} FROM {database}.raw_{entity} WHERE {_KEPT[entity]}"
        )
