"""One DuckDB statement per query."""

from __future__ import annotations

from accountloom.schemas import CORE_COLUMNS, ENTITIES, SOURCE_COLUMNS
from sqlcheck.chain import (
    HEALTH_AS_OF,
    NEXT_DAY,
    RENEWALS_AS_OF,
    RUN_DAY,
    date,
    email,
    initcap,
    initcap_delims,
    month,
    query,
    timestamp,
)


def _value(entity: str, expression: str) -> str:
    key = SOURCE_COLUMNS[entity][0]
    return f"SELECT {key} AS row_key, {expression} AS value FROM src_{entity}"


def _counts(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}"
        for name, source in tables.items()
    )


def _signups_of(customers: str) -> str:
    return f"""
        SELECT {month('signup_date')} AS signup_month, plan_tier, count(*) AS new_customers
        FROM raw_customers WHERE signup_date IS NOT NULL AND customer_id IN ({customers}) GROUP BY 1, 2"""


_RAW = {f"raw_{e}": f"raw_{e}" for e in ENTITIES}
_CORE = {m: m for m in CORE_COLUMNS}

_STATEMENTS = {
    **{f"scan_{e}": f"SELECT * FROM src_{e}" for e in ENTITIES},
    "scan_dated_zone": f"SELECT *, {NEXT_DAY} AS ingestion_date FROM src_deals",
    "land_sources": " UNION ALL ".join(
        f"SELECT '{e}' AS source, count(*) AS row_count, "
        f"count(DISTINCT {SOURCE_COLUMNS[e][0]}) AS distinct_keys, "
        f"count(DISTINCT customer_id) AS distinct_customers FROM src_{e}"
        for e in ENTITIES
    ),
    "sink_parquet_roundtrip": "SELECT * FROM raw_activities",
    "sink_append_table": """
        SELECT ingestion_date, deal_stage, 2 * count(*) AS row_count,
               count(DISTINCT deal_id) AS distinct_deals
        FROM raw_deals GROUP BY ALL""",
    "sink_reload_partition": """
        SELECT ingestion_date, deal_stage, count(*) AS row_count,
               count(DISTINCT deal_id) AS distinct_deals
        FROM twice_deals GROUP BY ALL""",
    "load_raw_tables": _counts(_RAW),
    "create_raw_tables": "SELECT * FROM raw_customers",
    "materialize_core": "SELECT * FROM dim_customers",
    "materialize_fact_deals": "SELECT * FROM fact_deals",
    "materialize_dim_subscriptions": "SELECT * FROM dim_subscriptions",
    **{f"stored_stg_{e}": f"SELECT * FROM stg_{e}" for e in ENTITIES},
    **{f"{m}_by_change": f"SELECT * FROM {m}_more" for m in CORE_COLUMNS},
    "retention_30d": f"SELECT * FROM snap_customers WHERE ingestion_date > {HEALTH_AS_OF} - 30",
    "retention_drop_days": f"""
        SELECT * FROM snap_customers WHERE ingestion_date > {HEALTH_AS_OF} - 30""",
    "retention_drop_folders": f"""
        SELECT {RUN_DAY} AS ingestion_date, count(*) AS row_count FROM src_deals""",
    "verify_counts": _counts({t: t for t in ("raw_customers", "raw_deals")}),
    "summed_deal_distribution_by_stage": """
        SELECT deal_stage, count(*) AS deal_count, round(sum(deal_value), 2) AS total_value,
               round(avg(deal_value), 2) AS avg_value
        FROM twice_deals GROUP BY deal_stage""",
    "summed_customer_signups_over_time": f"""
        SELECT {month('signup_date')} AS signup_month, plan_tier, count(*) AS new_customers
        FROM twice_customers WHERE signup_date IS NOT NULL GROUP BY 1, 2""",
    "summed_mrr_by_plan": """
        SELECT plan, status, count(*) AS customer_count, round(sum(mrr), 2) AS total_mrr,
               round(avg(mrr), 2) AS avg_mrr
        FROM twice_subscriptions WHERE mrr IS NOT NULL GROUP BY plan, status""",
    "health_check_on_a_day": f"""
        SELECT ingestion_date, count(*) AS records_ingested FROM snap_customers
        WHERE ingestion_date BETWEEN {HEALTH_AS_OF} - 7 AND {HEALTH_AS_OF} GROUP BY ingestion_date""",
    "read_pruned_range": """
        SELECT * FROM snap_customers
        WHERE ingestion_date BETWEEN DATE '2024-12-10' AND DATE '2024-12-20'
          AND plan_tier = 'growth'""",
    "add_ingestion_date": f"SELECT *, {RUN_DAY} AS ingestion_date FROM src_deals",
    "filter_not_null_keys": """
        SELECT * FROM raw_customers WHERE customer_id IS NOT NULL AND email IS NOT NULL""",
    "filter_positive_value": "SELECT * FROM raw_deals WHERE deal_value > 0 AND NOT isnan(deal_value)",
    "filter_unparsed_ts": "SELECT * FROM raw_activities WHERE timestamp IS NOT NULL",
    "filter_last_7_days": f"SELECT * FROM snap_customers WHERE ingestion_date >= {HEALTH_AS_OF} - 7",
    "join_inner_valid_contacts": "SELECT * FROM raw_contacts",
    "join_semi_valid_contacts": """
        SELECT * FROM typed_contacts
        WHERE customer_id IN (SELECT customer_id FROM raw_customers WHERE customer_id IS NOT NULL)""",
    "join_left_fact": "SELECT * FROM fact_deals",
    "join_left_chain": """
        SELECT c.customer_id, c.email, s.mrr, s.status AS subscription_status, a.activity_id, a.timestamp
        FROM stg_customers c
        LEFT JOIN stg_subscriptions s USING (customer_id)
        LEFT JOIN stg_activities a USING (customer_id)""",
    "join_left_subscriptions": "SELECT * FROM dim_subscriptions",
    "cross_filter_signups_by_stage": f"""
        SELECT {month('signup_date')} AS signup_month, plan_tier, count(*) AS new_customers
        FROM raw_customers
        WHERE signup_date IS NOT NULL
          AND customer_id IN (SELECT customer_id FROM raw_deals WHERE deal_stage = 'closed_won')
        GROUP BY 1, 2""",
    "cross_filter_by_bitmap": _signups_of("SELECT customer_id FROM raw_deals WHERE deal_stage = 'closed_won'"),
    "cross_filter_all_stages": _signups_of("""
        SELECT customer_id FROM raw_deals WHERE deal_stage IN ('closed_won', 'proposal', 'CLOSED_LOST')
        GROUP BY customer_id HAVING count(DISTINCT deal_stage) = 3"""),
    "cross_filter_no_deal_won": """
        SELECT * FROM raw_customers c
        WHERE NOT EXISTS (SELECT 1 FROM raw_deals d WHERE d.customer_id = c.customer_id AND deal_stage = 'closed_won')""",
    "cross_filter_stored_bitmaps": _signups_of("""
        SELECT customer_id FROM raw_deals WHERE deal_stage IN ('closed_won', 'proposal') AND deal_id % 10 < 5"""),
    "read_one_customer": "SELECT * FROM raw_deals WHERE customer_id = 31",
    "deal_distribution_by_stage": "SELECT * FROM deal_distribution_by_stage",
    "customer_signups_over_time": "SELECT * FROM customer_signups_over_time",
    "mrr_by_plan": "SELECT * FROM mrr_by_plan",
    "pipeline_health_check": "SELECT * FROM pipeline_health_check",
    "agg_count_distinct_activities": """
        SELECT customer_id, count(DISTINCT activity_id) AS total_activities
        FROM stg_activities GROUP BY customer_id""",
    "agg_last_activity": """
        SELECT customer_id, max(timestamp) AS last_activity_at
        FROM stg_activities GROUP BY customer_id""",
    "tile_deals_by_stage": """
        SELECT deal_stage, cast(sum(deal_count) AS bigint) AS deal_count, sum(total_value) AS total_value
        FROM deal_distribution_by_stage GROUP BY deal_stage""",
    "tile_signups_by_tier": """
        SELECT signup_month, plan_tier, cast(sum(new_customers) AS bigint) AS new_customers
        FROM customer_signups_over_time GROUP BY ALL""",
    "tile_signups_one_tier": "SELECT * FROM customer_signups_over_time WHERE plan_tier = 'Starter'",
    "tile_mrr_by_plan": "SELECT plan, round(sum(total_mrr), 2) AS total_mrr FROM mrr_by_plan GROUP BY plan",
    "dedup_customers_by_email": "SELECT customer_id, email, name FROM raw_customers",
    "fn_normalize_enum": _value("deals", "lower(deal_stage)"),
    "fn_normalize_email": _value("customers", email("email")),
    "fn_initcap_company": _value("customers", initcap("company")),
    "fn_initcap_delims": _value("customers", initcap_delims("company")),
    "fn_try_cast_int": _value("customers", "try_cast(customer_id AS bigint)"),
    "fn_try_cast_double": _value("deals", "try_cast(deal_value AS double)"),
    "fn_parse_date": _value("customers", date("signup_date")),
    "fn_parse_timestamp": _value("activities", timestamp("timestamp")),
    "fn_round_money": _value("deals", "round(try_cast(deal_value AS double), 2)"),
    "fn_month_trunc": _value("customers", month(date("signup_date"))),
    "fn_days_until": _value(
        "subscriptions", f"cast(date_diff('day', {RENEWALS_AS_OF}, {date('renewal_date')}) AS int)"
    ),
    **{f"clean_{e}": f"SELECT * FROM raw_{e}" for e in ENTITIES},
    **{f"stg_{e}": f"SELECT * FROM stg_{e}" for e in ENTITIES},
    "stg_customers_warehouse_text": f"""
        SELECT * REPLACE ({initcap_delims('company')} AS company) FROM stg_customers""",
    **{m: f"SELECT * FROM {m}" for m in CORE_COLUMNS},
    **{f"{m}_two_days": f"SELECT * FROM {m}_twice" for m in CORE_COLUMNS},
    **{f"{m}_snapshot": f"SELECT * FROM {m}" for m in CORE_COLUMNS},
    "daily_run": _counts({**_RAW, **_CORE}),
    "daily_run_repeated": _counts({**_RAW, **_CORE}),
    "sql_over_views": """
        SELECT f.plan_tier, v.deal_stage, v.deal_count AS stage_deals, count(*) AS deals,
               count(DISTINCT d.customer_id) AS active_customers
        FROM fact_deals f
        JOIN deal_distribution_by_stage v ON lower(v.deal_stage) = f.deal_stage
        LEFT JOIN dim_customers d ON d.customer_id = f.customer_id AND d.total_activities > 0
        GROUP BY ALL""",
}


def all_oracles() -> dict[str, str]:
    return {name: query(sql) for name, sql in _STATEMENTS.items()}
