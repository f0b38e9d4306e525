"""Text sources to typed rows. Bad ids, numbers and dates become NULL.

Ids are 64 bits wide; id_type="int" gives narrow ones, which lose larger ids.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame

from accountloom.functions import (
    WIDE,
    capitalize_words,
    normalize_email,
    parse_date,
    parse_timestamp,
    to_double,
    to_int,
)
from accountloom.operators import first_per_key, semi_join, surviving_ids, with_ingestion_date


def type_customers(src: DataFrame, day: dt.date | str, id_type: str = WIDE) -> DataFrame:
    typed = src.withColumns(
        {
            "customer_id": to_int("customer_id", id_type),
            "email": normalize_email("email"),
            "company": capitalize_words("company"),
            "signup_date": parse_date("signup_date"),
        }
    )
    return with_ingestion_date(typed, day)


def clean_customers(src: DataFrame, day: dt.date | str, id_type: str = WIDE) -> DataFrame:
    """One customer per e-mail, the one with the lowest id.

    An id that failed to parse sorts lowest, so such a row displaces the others
    of its e-mail; staging then drops it.
    """
    return first_per_key(type_customers(src, day, id_type), "email", "customer_id")


def customer_ids(src_customers: DataFrame, id_type: str = WIDE) -> DataFrame:
    """Ids of clean_customers, for joins: reads two columns and sorts nothing."""
    typed = src_customers.select(
        normalize_email("email").alias("email"),
        to_int("customer_id", id_type).alias("customer_id"),
    )
    return surviving_ids(typed, "email", "customer_id")


def type_contacts(src: DataFrame, day: dt.date | str, id_type: str = WIDE) -> DataFrame:
    typed = src.withColumns(
        {
            "contact_id": to_int("contact_id", id_type),
            "customer_id": to_int("customer_id", id_type),
            "email": normalize_email("email"),
        }
    )
    return with_ingestion_date(typed, day)


def clean_contacts(
    src: DataFrame, ids: DataFrame, day: dt.date | str, id_type: str = WIDE
) -> DataFrame:
    """Contacts of known customers; an id that repeats in ids repeats its contacts."""
    return type_contacts(src, day, id_type).join(ids, "customer_id", "inner")


def clean_contacts_once(
    src: DataFrame, ids: DataFrame, day: dt.date | str, id_type: str = WIDE
) -> DataFrame:
    """Contacts of known customers, each contact once."""
    return semi_join(type_contacts(src, day, id_type), ids, "customer_id")


def clean_deals(src: DataFrame, day: dt.date | str, id_type: str = WIDE) -> DataFrame:
    typed = src.withColumns(
        {
            "deal_id": to_int("deal_id", id_type),
            "customer_id": to_int("customer_id", id_type),
            "deal_value": to_double("deal_value"),
            "close_date": parse_date("close_date"),
        }
    )
    return with_ingestion_date(typed, day)


def clean_activities(src: DataFrame, day: dt.date | str, id_type: str = WIDE) -> DataFrame:
    typed = src.withColumns(
        {
            "activity_id": to_int("activity_id", id_type),
            "customer_id": to_int("customer_id", id_type),
            "timestamp": parse_timestamp("timestamp"),
        }
    )
    return with_ingestion_date(typed, day)


def clean_subscriptions(src: DataFrame, day: dt.date | str, id_type: str = WIDE) -> DataFrame:
    typed = src.withColumns(
        {
            "subscription_id": to_int("subscription_id", id_type),
            "customer_id": to_int("customer_id", id_type),
            "mrr": to_double("mrr"),
            "renewal_date": parse_date("renewal_date"),
        }
    )
    return with_ingestion_date(typed, day)


# The sources cleaned on their own; contacts need the customers as well.
CLEANERS = {
    "customers": clean_customers,
    "deals": clean_deals,
    "activities": clean_activities,
    "subscriptions": clean_subscriptions,
}


def clean_all(
    sources: Mapping[str, DataFrame], day: dt.date | str, id_type: str = WIDE
) -> dict[str, DataFrame]:
    ids = customer_ids(sources["customers"], id_type)
    cleaned = {e: clean(sources[e], day, id_type) for e, clean in CLEANERS.items()}
    return {**cleaned, "contacts": clean_contacts(sources["contacts"], ids, day, id_type)}
