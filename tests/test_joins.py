from __future__ import annotations

import random

import pytest

from accountloom.operators import left_join, left_join_unique, semi_join
from tests.support import rows, settings


def _frame(spark, seed, size, value, keys=8):
    rnd = random.Random(seed)

    def key():
        # A third of all rows on one key, and some on none.
        draw = rnd.random()
        return 1 if draw < 0.33 else None if draw < 0.4 else rnd.randrange(keys)

    data = [(key(), rnd.randrange(3)) for _ in range(size)]
    return spark.createDataFrame(data, f"k int, {value} int")


CASES = [(seed, hot) for seed in range(3) for hot in (0, 2, 10, 1_000_000)]


@pytest.mark.parametrize("seed, hot", CASES)
@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
def test_left_join_equals_the_plain_one(spark, seed, hot, broadcast):
    left, right = _frame(spark, seed, 60, "a"), _frame(spark, seed + 9, 40, "b", keys=12)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=broadcast):
        assert rows(left_join(left, right, "k", hot)) == rows(left.join(right, "k", "left"))


@pytest.mark.parametrize("seed, hot", CASES)
def test_left_join_to_unique_keys_equals_the_plain_one(spark, seed, hot):
    left = _frame(spark, seed, 60, "a")
    right = _frame(spark, seed + 9, 40, "b", keys=12).groupBy("k").count()
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert rows(left_join_unique(left, right, "k", hot)) == rows(left.join(right, "k", "left"))


@pytest.mark.parametrize("seed, hot", CASES)
def test_semi_join_equals_the_plain_one(spark, seed, hot):
    left, right = _frame(spark, seed, 60, "a", keys=20), _frame(spark, seed + 9, 40, "b")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert rows(semi_join(left, right, "k", hot)) == rows(left.join(right, "k", "left_semi"))


def test_joins_to_nothing(spark):
    left, right = _frame(spark, 1, 20, "a"), _frame(spark, 2, 0, "b")
    assert rows(left_join(left, right, "k")) == rows(left.join(right, "k", "left"))
    assert semi_join(left, right, "k").count() == 0
    assert left_join(right, left, "k").count() == 0
