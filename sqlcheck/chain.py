"""The layers as DuckDB common table expressions."""

from __future__ import annotations

import re

from accountloom.schemas import ENTITIES
from accountloom.sources.derived import FROM, Dialect, source_expressions

RUN_DAY = "DATE '2025-01-01'"
NEXT_DAY = "DATE '2025-01-02'"
RENEWALS_AS_OF = "DATE '2002-01-01'"
HEALTH_AS_OF = "DATE '2025-01-07'"

_STRFTIME = {"yyyy": "%Y", "MM": "%m", "dd": "%d", "HH": "%H", "mm": "%M", "ss": "%S"}


def _strftime(form: str) -> str:
    return re.sub("yyyy|MM|dd|HH|mm|ss", lambda m: _STRFTIME[m.group()], form)


DUCKDB = Dialect(
    text="varchar",
    format=lambda x, form: f"strftime({x}, '{_strftime(form)}')",
    plus_days=lambda d, n: f"({d} + cast({n} as int))",
)


def email(x: str) -> str:
    return f"lower(trim({x}))"


def initcap(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower(trim({x})), ' '), "
        "lambda w: concat(upper(w[1]), w[2:])), ' ')"
    )


def initcap_delims(x: str) -> str:
    delimiters = r"\s\[\](){}/|\\<>!?@\x22^#$&~_,.:;*%+\-"
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower(trim({x})), "
        f"'([^{delimiters}]+|[{delimiters}])'), lambda w: concat(upper(w[1]), w[2:])), '')"
    )


def date(x: str) -> str:
    return f"cast(coalesce(try_strptime({x}, '%Y-%m-%d'), try_strptime({x}, '%m/%d/%Y')) as date)"


def timestamp(x: str) -> str:
    return (
        f"coalesce(try_strptime({x}, '%Y-%m-%d %H:%M:%S'), try_strptime({x}, '%m/%d/%Y %H:%M'))"
    )


def month(x: str) -> str:
    return f"cast(date_trunc('month', {x}) as date)"


def _source(entity: str) -> str:
    columns = ", ".join(
        f"{x} AS {c}" for c, x in source_expressions(entity, DUCKDB).items()
    )
    return f"SELECT {columns} FROM {FROM[entity]}"


CTES = {f"src_{e}": _source(e) for e in ENTITIES}

CTES["typed_customers"] = f"""
    SELECT try_cast(customer_id AS bigint) AS customer_id, name, {email('email')} AS email,
           {initcap('company')} AS company, {date('signup_date')} AS signup_date,
           plan_tier, country, {RUN_DAY} AS ingestion_date
    FROM src_customers"""

CTES["raw_customers"] = """
    SELECT * FROM typed_customers
    QUALIFY row_number() OVER (
        PARTITION BY email
        ORDER BY customer_id NULLS FIRST, name NULLS FIRST, company NULLS FIRST,
                 signup_date NULLS FIRST, plan_tier NULLS FIRST, country NULLS FIRST) = 1"""

CTES["typed_contacts"] = f"""
    SELECT try_cast(customer_id AS bigint) AS customer_id, try_cast(contact_id AS bigint) AS contact_id,
           first_name, last_name, {email('email')} AS email, phone, role, {RUN_DAY} AS ingestion_date
    FROM src_contacts"""

CTES["raw_contacts"] = """
    SELECT k.* FROM typed_contacts k JOIN raw_customers c ON k.customer_id = c.customer_id"""

CTES["raw_deals"] = f"""
    SELECT try_cast(deal_id AS bigint) AS deal_id, try_cast(customer_id AS bigint) AS customer_id,
           try_cast(deal_value AS double) AS deal_value, deal_stage,
           {date('close_date')} AS close_date, owner, {RUN_DAY} AS ingestion_date
    FROM src_deals"""

CTES["raw_activities"] = f"""
    SELECT try_cast(activity_id AS bigint) AS activity_id, try_cast(customer_id AS bigint) AS customer_id,
           activity_type, {timestamp('timestamp')} AS timestamp, outcome, notes,
           {RUN_DAY} AS ingestion_date
    FROM src_activities"""

CTES["raw_subscriptions"] = f"""
    SELECT try_cast(subscription_id AS bigint) AS subscription_id,
           try_cast(customer_id AS bigint) AS customer_id, plan, try_cast(mrr AS double) AS mrr,
           {date('renewal_date')} AS renewal_date, status, {RUN_DAY} AS ingestion_date
    FROM src_subscriptions"""

for _entity in ENTITIES:
    CTES[f"twice_{_entity}"] = f"""
    SELECT * FROM raw_{_entity}
    UNION ALL SELECT * REPLACE ({NEXT_DAY} AS ingestion_date) FROM raw_{_entity}"""

    CTES[f"more_{_entity}"] = f"""
    SELECT * FROM raw_{_entity}
    UNION ALL SELECT * REPLACE ({NEXT_DAY} AS ingestion_date) FROM raw_{_entity} WHERE customer_id % 10 = 3"""

CTES["snap_customers"] = """
    SELECT * REPLACE (DATE '2024-12-01' + cast(customer_id % 45 AS int) AS ingestion_date)
    FROM raw_customers"""


def _stage(prefix: str, raw: str) -> None:
    CTES[f"{prefix}customers"] = f"""
    SELECT * REPLACE ({email('email')} AS email, {initcap('company')} AS company,
                      lower(plan_tier) AS plan_tier)
    FROM {raw}customers WHERE customer_id IS NOT NULL AND email IS NOT NULL"""
    CTES[f"{prefix}contacts"] = f"""
    SELECT * REPLACE ({email('email')} AS email)
    FROM {raw}contacts WHERE contact_id IS NOT NULL AND customer_id IS NOT NULL"""
    CTES[f"{prefix}deals"] = f"""
    SELECT * REPLACE (round(deal_value, 2) AS deal_value, lower(deal_stage) AS deal_stage)
    FROM {raw}deals
    WHERE deal_id IS NOT NULL AND customer_id IS NOT NULL AND deal_value > 0
      AND NOT isnan(deal_value)"""
    CTES[f"{prefix}activities"] = f"""
    SELECT * REPLACE (lower(activity_type) AS activity_type, lower(outcome) AS outcome)
    FROM {raw}activities
    WHERE activity_id IS NOT NULL AND customer_id IS NOT NULL AND timestamp IS NOT NULL"""
    CTES[f"{prefix}subscriptions"] = f"""
    SELECT * REPLACE (lower(plan) AS plan, lower(status) AS status)
    FROM {raw}subscriptions WHERE subscription_id IS NOT NULL AND customer_id IS NOT NULL"""


def _core(stage: str, suffix: str) -> None:
    CTES[f"fact_deals{suffix}"] = f"""
    SELECT d.*, c.plan_tier, c.company, c.country
    FROM {stage}deals d LEFT JOIN {stage}customers c USING (customer_id)"""
    CTES[f"dim_customers{suffix}"] = f"""
    SELECT c.*, s.mrr, s.status AS subscription_status, s.renewal_date,
           count(DISTINCT a.activity_id) AS total_activities, max(a.timestamp) AS last_activity_at
    FROM {stage}customers c
    LEFT JOIN {stage}subscriptions s ON s.customer_id = c.customer_id
    LEFT JOIN {stage}activities a ON a.customer_id = c.customer_id
    GROUP BY ALL"""
    CTES[f"dim_subscriptions{suffix}"] = f"""
    SELECT s.*, c.company, c.country, c.signup_date AS customer_since,
           cast(date_diff('day', {RENEWALS_AS_OF}, s.renewal_date) AS int) AS days_until_renewal
    FROM {stage}subscriptions s LEFT JOIN {stage}customers c USING (customer_id)"""


_stage("stg_", "raw_")
_core("stg_", "")
_stage("stg_twice_", "twice_")
_core("stg_twice_", "_twice")
_stage("stg_more_", "more_")
_core("stg_more_", "_more")

CTES["deal_distribution_by_stage"] = """
    SELECT deal_stage, count(*) AS deal_count, round(sum(deal_value), 2) AS total_value,
           round(avg(deal_value), 2) AS avg_value
    FROM raw_deals GROUP BY deal_stage"""

CTES["customer_signups_over_time"] = f"""
    SELECT {month('signup_date')} AS signup_month, plan_tier, count(*) AS new_customers
    FROM raw_customers WHERE signup_date IS NOT NULL GROUP BY 1, 2"""

CTES["mrr_by_plan"] = """
    SELECT plan, status, count(*) AS customer_count, round(sum(mrr), 2) AS total_mrr,
           round(avg(mrr), 2) AS avg_mrr
    FROM raw_subscriptions WHERE mrr IS NOT NULL GROUP BY plan, status"""

CTES["pipeline_health_check"] = f"""
    SELECT ingestion_date, count(*) AS records_ingested
    FROM snap_customers WHERE ingestion_date >= {HEALTH_AS_OF} - 7 GROUP BY ingestion_date"""


def _needed(sql: str, seen: list[str]) -> None:
    for name in re.findall(r"\w+", sql):
        if name in CTES and name not in seen:
            _needed(CTES[name], seen)
            if name not in seen:
                seen.append(name)


def query(sql: str) -> str:
    """The statement, preceded by the layers it names, directly or through others."""
    names: list[str] = []
    _needed(sql, names)
    layers = ",\n".join(f"{n} AS ({CTES[n]})" for n in names)
    return f"WITH {layers}\n{sql}"
