"""Star schema over the staging layer: one fact, two dimensions.

The models join on customer_id alone. With several days in the staging tables
each day's rows therefore meet the customers of all days; pass `snapshot` to
build from one day only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountloom.functions import days_until
from accountloom.operators import left_join, left_join_unique, within_days
from accountloom.operators.joins import HOT_ROWS
from accountloom.schemas import CORE_COLUMNS


def _one_day(df: DataFrame, snapshot: dt.date | str | None) -> DataFrame:
    return df if snapshot is None else within_days(df, snapshot, snapshot)


def fact_deals(
    deals: DataFrame,
    customers: DataFrame,
    snapshot: dt.date | str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Deals with tier, company and country of their customer, if there is one."""
    attributes = _one_day(customers, snapshot).select(
        "customer_id", "plan_tier", "company", "country"
    )
    joined = left_join(_one_day(deals, snapshot), attributes, "customer_id", hot_rows)
    return joined.select(CORE_COLUMNS["fact_deals"])


def activity_summary(activities: DataFrame) -> DataFrame:
    """Distinct activities and latest one per customer.

    The distinct count shuffles by customer and activity first, so a customer
    with very many activities is counted by many tasks.
    """
    return activities.groupBy("customer_id").agg(
        F.count_distinct("activity_id").alias("total_activities"),
        F.max("timestamp").alias("last_activity_at"),
    )


def dim_customers(
    customers: DataFrame,
    subscriptions: DataFrame,
    activities: DataFrame,
    snapshot: dt.date | str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Customers with their subscription, activity count and latest activity.

    One row per distinct customer row and distinct (mrr, status, renewal_date).
    Activities are summed up and plans made distinct before the joins: joining
    first would build customers x subscriptions x activities only to group it
    again, and with n stored days n x n rows per customer. The last distinct
    works on rows the joins have already brought together by customer.
    """
    people = _one_day(customers, snapshot)
    plans = (
        _one_day(subscriptions, snapshot)
        .select("customer_id", "mrr", F.col("status").alias("subscription_status"), "renewal_date")
        .distinct()
    )
    summary = activity_summary(_one_day(activities, snapshot))
    counted = left_join_unique(people, summary, "customer_id", hot_rows).withColumn(
        "total_activities", F.coalesce("total_activities", F.lit(0))
    )
    joined = left_join(counted, plans, "customer_id", hot_rows)
    return joined.select(CORE_COLUMNS["dim_customers"]).distinct()


def customer_activity_chain(
    customers: DataFrame,
    subscriptions: DataFrame,
    activities: DataFrame,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """A row per customer, subscription and activity, customers without either kept."""
    plans = subscriptions.select(
        "customer_id", "mrr", F.col("status").alias("subscription_status"), "renewal_date"
    )
    events = activities.select("customer_id", "activity_id", "timestamp")
    chain = left_join(customers, plans, "customer_id", hot_rows)
    return left_join(chain, events, "customer_id", hot_rows)


def dim_subscriptions(
    subscriptions: DataFrame,
    customers: DataFrame,
    as_of: dt.date | str | None = None,
    snapshot: dt.date | str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Subscriptions with their customer's attributes and the days to renewal.

    Stored as a table, the days are as of the build (or the given as_of).
    """
    attributes = _one_day(customers, snapshot).select(
        "customer_id", "company", "country", F.col("signup_date").alias("customer_since")
    )
    joined = left_join(_one_day(subscriptions, snapshot), attributes, "customer_id", hot_rows)
    return joined.withColumn("days_until_renewal", days_until("renewal_date", as_of)).select(
        CORE_COLUMNS["dim_subscriptions"]
    )


def build_core(
    staged: Mapping[str, DataFrame],
    as_of: dt.date | str | None = None,
    snapshot: dt.date | str | None = None,
) -> dict[str, DataFrame]:
    customers, subscriptions = staged["customers"], staged["subscriptions"]
    return {
        "fact_deals": fact_deals(staged["deals"], customers, snapshot),
        "dim_customers": dim_customers(customers, subscriptions, staged["activities"], snapshot),
        "dim_subscriptions": dim_subscriptions(subscriptions, customers, as_of, snapshot),
    }
