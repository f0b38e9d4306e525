"""Joins on one key column that stay balanced when a key is over-full.

Adaptive execution splits a skewed shuffle partition on the left of a left or
semi join and on both sides of an inner join, if the shuffle feeds the join
directly. The functions below cover what that leaves: keys over-full on the
right of a left join, and keys over-full on the left when the right side is an
aggregate. Both single such keys out, which hot_keys() finds before the join is
planned. At most rows / hot_rows keys can be, so their list may be broadcast.
Where there is none, the plan is the plain join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountloom.operators.hot_keys import HOT_ROWS, hot_keys


def left_join(
    left: DataFrame, right: DataFrame, key: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Left outer join to a right side that may repeat keys.

    Every over-full right key has a match by definition, so for those keys the
    join is an inner one, which adaptive execution can split on either side.
    """
    hot = hot_keys(right, key, hot_rows)
    if hot is None:
        return left.join(right, key, "left")
    cold = left.join(hot, key, "left_anti").join(right.join(hot, key, "left_anti"), key, "left")
    full = left.join(hot, key, "left_semi").join(right.join(hot, key, "left_semi"), key, "inner")
    return cold.unionByName(full)


def left_join_unique(
    left: DataFrame, right: DataFrame, key: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Left outer join to a right side that holds each key at most once.

    The right rows of over-full left keys are as few as those keys. Rows without
    a key are not set apart; drop them first if there are many.
    """
    hot = hot_keys(left, key, hot_rows)
    if hot is None:
        return left.join(right, key, "left")
    few = F.broadcast(right.join(hot, key, "left_semi"))
    cold = left.join(hot, key, "left_anti").join(right, key, "left")
    full = left.join(hot, key, "left_semi").join(few, key, "left")
    return cold.unionByName(full)


def semi_join(
    left: DataFrame, right: DataFrame, key: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Left rows whose key occurs on the right, each once.

    Right keys are made distinct on the way to the join, in the shuffle the join
    needs anyway, so a key repeated there costs one row per task.
    """
    keys = right.select(key).distinct()
    hot = hot_keys(left, key, hot_rows)
    if hot is None:
        return left.join(keys, key, "left_semi")
    found = F.broadcast(keys.join(hot, key, "left_semi"))
    cold = left.join(hot, key, "left_anti").join(keys, key, "left_semi")
    return cold.unionByName(left.join(found, key, "left_semi"))
