"""Reports on stored sums: a few rows per day and group instead of the raw rows.

Each raw table that a report reads has a table of partial sums beside it, one partition a
day. A load computes its day's sums anew from that day alone and switches them in one
step, so appending, reloading and repeating a load all leave them equal to the raw rows;
retention drops them with the day. The reports add them up. Rows without a day are in no
sum.
"""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from accountloom.operators import require, within_days
from accountloom.schemas import DAY, SUM_COLUMNS
from accountloom.settings import setting
from accountloom.sources import warehouse
from accountloom.sources.parallel import write_together

# What is kept of a day, by raw table.
_PARTIAL = {
    "deals": """
        FROM {rows}
        |> AGGREGATE count(*) AS n_rows, count(deal_value) AS n_values, sum(deal_value) AS total
           GROUP BY deal_stage""",
    "customers": """
        FROM {rows} |> AGGREGATE count(*) AS n_rows GROUP BY trunc(signup_date, 'MM') AS signup_month, plan_tier""",
    "subscriptions": """
        FROM {rows} |> AGGREGATE count(*) AS n_rows, count(mrr) AS n_values, sum(mrr) AS total GROUP BY plan, status""",
}

# The reports over the sums: what they read, their columns, and the query. {sums} is the
# table, {as_of} the day that the report looks from.
_REPORTS = {
    "deal_distribution_by_stage": (
        "deals",
        "deal_stage STRING, deal_count BIGINT, total_value DOUBLE, avg_value DOUBLE",
        f"""
        FROM {{sums}} |> WHERE {DAY} <= {{as_of}}
        |> AGGREGATE sum(n_rows) AS deal_count, round(sum(total), 2) AS total_value,
                     round(try_divide(sum(total), sum(n_values)), 2) AS avg_value
           GROUP BY deal_stage
        |> ORDER BY deal_count DESC""",
    ),
    "customer_signups_over_time": (
        "customers",
        "signup_month DATE, plan_tier STRING, new_customers BIGINT",
        f"""
        FROM {{sums}} |> WHERE {DAY} <= {{as_of}} AND signup_month IS NOT NULL
        |> AGGREGATE sum(n_rows) AS new_customers GROUP BY signup_month, plan_tier
        |> ORDER BY signup_month""",
    ),
    "mrr_by_plan": (
        "subscriptions",
        "plan STRING, status STRING, customer_count BIGINT, total_mrr DOUBLE, avg_mrr DOUBLE",
        f"""
        FROM {{sums}} |> WHERE {DAY} <= {{as_of}} AND n_values > 0
        |> AGGREGATE sum(n_values) AS customer_count, round(sum(total), 2) AS total_mrr,
                     round(sum(total) / sum(n_values), 2) AS avg_mrr
           GROUP BY plan, status
        |> ORDER BY total_mrr DESC""",
    ),
    "pipeline_health_check": (
        "customers",
        f"{DAY} DATE, records_ingested BIGINT",
        f"""
        FROM {{sums}} |> WHERE {DAY} >= date_sub({{as_of}}, 7) AND {DAY} <= {{until}}
        |> AGGREGATE sum(n_rows) AS records_ingested GROUP BY {DAY}
        |> ORDER BY {DAY} DESC""",
    ),
}
_ALL_TIME = "DATE '9999-12-31'"


def _table(entity: str) -> str:
    return f"sums_{entity}"


def _summed(rows: DataFrame, entity: str) -> DataFrame:
    text = _PARTIAL[entity].replace("GROUP BY ", f"GROUP BY {DAY}, ")
    return rows.sparkSession.sql(text, rows=rows).select(SUM_COLUMNS[entity])


def create_table(spark: SparkSession, database: str) -> None:
    """Create the tables of sums if they are absent."""
    for entity, columns in SUM_COLUMNS.items():
        warehouse.create_table(spark, database, _table(entity), columns)


def refresh(spark: SparkSession, database: str, day: dt.date | str | None = None) -> None:
    """Compute the sums of a day, or of all stored days, from the raw tables.

    A day's sums are switched in one step. All days are written in one job.
    """
    create_table(spark, database)

    def one(entity: str) -> None:
        raw = warehouse.raw_table(spark, database, entity)
        rows = raw if day is None else within_days(raw, day, day)
        # Stages, tiers and plans are few; a day's sums are one small file.
        sums = _summed(require(rows, DAY), entity).coalesce(1)
        if day is None:
            with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
                sums.write.mode("overwrite").insertInto(f"{database}.{_table(entity)}")
        else:
            warehouse.replace_day(sums, database, _table(entity), day)

    if day is None:
        for entity in SUM_COLUMNS:
            one(entity)
    else:
        write_together(spark, [partial(one, e) for e in SUM_COLUMNS])


def drop_expired(spark: SparkSession, database: str, as_of: dt.date | str | None, days: int) -> None:
    for entity in SUM_COLUMNS:
        warehouse.drop_expired_days(spark, database, _table(entity), as_of, days)


def create_views(spark: SparkSession, database: str) -> None:
    """The four reports as stored views over the sums; each query looks from its own day."""
    create_table(spark, database)
    for name, (entity, _, text) in _REPORTS.items():
        today = "current_date()" if name == "pipeline_health_check" else _ALL_TIME
        body = text.format(sums=f"{database}.{_table(entity)}", as_of=today, until=_ALL_TIME)
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {body}")


def create_functions(spark: SparkSession, database: str) -> None:
    """The four reports as stored table functions of a day: `SELECT * FROM mrr_by_plan_on(DATE '...')`.

    A report as of a day adds up what had been ingested by then. Table functions are
    called without their database, which has to be the current one.
    """
    create_table(spark, database)
    for name, (entity, columns, text) in _REPORTS.items():
        body = text.format(sums=f"{database}.{_table(entity)}", as_of="as_of", until="as_of")
        spark.sql(
            f"CREATE OR REPLACE FUNCTION {database}.{name}_on(as_of DATE DEFAULT current_date()) "
            f"RETURNS TABLE ({columns}) RETURN {body}"
        )
