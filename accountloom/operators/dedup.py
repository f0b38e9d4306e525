"""One row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: str, order_by: str) -> DataFrame:
    """Keep the row with the lowest order_by of each key, NULL being lowest.

    A NULL key is a group like any other. Rows equal in both are ordered by the
    other columns, so that a task run again keeps the same one. Catalyst cuts
    each task's input to one row per key before the shuffle, so a key that holds
    a third of all rows reaches its reducer as one row per task.
    """
    ties = [c for c in df.columns if c not in (key, order_by)]
    first = Window.partitionBy(key).orderBy(
        F.asc_nulls_first(order_by), *[F.asc_nulls_first(c) for c in ties]
    )
    return (
        df.withColumn("_row", F.row_number().over(first)).filter(F.col("_row") == 1).drop("_row")
    )


def surviving_ids(df: DataFrame, key: str, id_column: str) -> DataFrame:
    """The non-null ids that first_per_key keeps, without ordering whole rows.

    A group that holds a NULL id keeps that row, hence no usable id. Ids repeat
    if they are the lowest of several keys.
    """
    return (
        df.groupBy(key)
        .agg(
            F.min(id_column).alias(id_column),
            F.max(F.col(id_column).isNull()).alias("_lost"),
        )
        .filter(~F.col("_lost"))
        .select(id_column)
    )
