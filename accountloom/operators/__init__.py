"""Operators on whole DataFrames."""

from accountloom.operators.dedup import first_per_key, surviving_ids
from accountloom.operators.filters import (
    keep_recent,
    positive,
    require,
    retain,
    with_ingestion_date,
    within_days,
)
from accountloom.operators.joins import left_join, left_join_unique, semi_join

__all__ = [
    "first_per_key",
    "keep_recent",
    "left_join",
    "left_join_unique",
    "positive",
    "require",
    "retain",
    "semi_join",
    "surviving_ids",
    "with_ingestion_date",
    "within_days",
]
