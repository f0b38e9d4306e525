"""Reports over the raw tables, and the dashboard tiles built on them.

Raw values are not normalized, so spellings that differ in case count apart.
Every grouping here is by a short list of values (stage, plan, month, day) and
every aggregate combines before the shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountloom.functions import round_money, run_date
from accountloom.operators import semi_join
from accountloom.operators.joins import HOT_ROWS
from accountloom.schemas import DAY


# One definition per report, for frames and for stored views. {rows} is the frame or
# table it reads, {today} the day it looks from.
REPORTS = {
    "deal_distribution_by_stage": (
        "deals",
        """
        FROM {rows}
        |> AGGREGATE count(*) AS deal_count, round(sum(deal_value), 2) AS total_value,
                     round(avg(deal_value), 2) AS avg_value
           GROUP BY deal_stage
        |> ORDER BY deal_count DESC""",
    ),
    "customer_signups_over_time": (
        "customers",
        """
        FROM {rows}
        |> WHERE signup_date IS NOT NULL
        |> AGGREGATE count(*) AS new_customers
           GROUP BY trunc(signup_date, 'MM') AS signup_month, plan_tier
        |> ORDER BY signup_month""",
    ),
    "mrr_by_plan": (
        "subscriptions",
        """
        FROM {rows}
        |> WHERE mrr IS NOT NULL
        |> AGGREGATE count(*) AS customer_count, round(sum(mrr), 2) AS total_mrr,
                     round(avg(mrr), 2) AS avg_mrr
           GROUP BY plan, status
        |> ORDER BY total_mrr DESC""",
    ),
    "pipeline_health_check": (
        "customers",
        f"""
        FROM {{rows}}
        |> WHERE {DAY} >= date_sub({{today}}, 7)
        |> AGGREGATE count(*) AS records_ingested GROUP BY {DAY}
        |> ORDER BY {DAY} DESC""",
    ),
}


def _report(name: str, rows: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    today = "current_date()" if as_of is None else f"DATE '{run_date(as_of).isoformat()}'"
    text = REPORTS[name][1].replace("{today}", today)
    return rows.sparkSession.sql(text, rows=rows)


def deal_distribution_by_stage(deals: DataFrame) -> DataFrame:
    return _report("deal_distribution_by_stage", deals)


def customer_signups_over_time(customers: DataFrame) -> DataFrame:
    return _report("customer_signups_over_time", customers)


def mrr_by_plan(subscriptions: DataFrame) -> DataFrame:
    return _report("mrr_by_plan", subscriptions)


def pipeline_health_check(customers: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Rows per ingestion day of the last week; days without rows are absent."""
    return _report("pipeline_health_check", customers, as_of)


def tile_deals_by_stage(distribution: DataFrame) -> DataFrame:
    return (
        distribution.groupBy("deal_stage")
        .agg(F.sum("deal_count").alias("deal_count"), F.sum("total_value").alias("total_value"))
        .orderBy(F.desc("deal_count"))
    )


def tile_signups_by_tier(signups: DataFrame) -> DataFrame:
    """A row per month and tier, whatever tiers there are; no tier is one of them."""
    return (
        signups.groupBy("signup_month", "plan_tier")
        .agg(F.sum("new_customers").alias("new_customers"))
        .orderBy("signup_month", "plan_tier")
    )


def tile_signups_wide(signups: DataFrame, tiers: Sequence[str]) -> DataFrame:
    """A row per month and a column per tier; fails if a tier is not listed."""
    known = F.coalesce(F.col("plan_tier").isin(list(tiers)), F.lit(False))
    message = F.concat(F.lit("tier not listed: "), F.coalesce("plan_tier", F.lit("NULL")))
    checked = F.when(known, F.col("plan_tier")).otherwise(F.raise_error(message))
    return (
        signups.withColumn("plan_tier", checked)
        .groupBy("signup_month")
        .pivot("plan_tier", list(tiers))
        .agg(F.sum("new_customers"))
        .orderBy("signup_month")
    )


def tile_signups_one_tier(signups: DataFrame, tier: str) -> DataFrame:
    return signups.filter(F.col("plan_tier") == tier).orderBy("signup_month")


def tile_mrr_by_plan(mrr: DataFrame) -> DataFrame:
    return mrr.groupBy("plan").agg(round_money(F.sum("total_mrr")).alias("total_mrr"))


def signups_by_stage(
    customers: DataFrame, deals: DataFrame, stage: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The signups report over customers that have a deal in the stage."""
    chosen = deals.filter(F.col("deal_stage") == stage)
    return customer_signups_over_time(semi_join(customers, chosen, "customer_id", hot_rows))


def register_reports(raw: Mapping[str, DataFrame], as_of: dt.date | str | None = None) -> None:
    """The four reports as temporary views over any frames of the raw layer."""
    for name, (entity, _) in REPORTS.items():
        _report(name, raw[entity], as_of).createOrReplaceTempView(name)


def create_report_views(spark: SparkSession, database: str) -> None:
    """The four reports as stored views; each query sees the tables and the day as they are then."""
    for name, (entity, text) in REPORTS.items():
        body = text.format(rows=f"{database}.raw_{entity}", today="current_date()")
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {body}")
