"""Small helpers for the tests."""

from __future__ import annotations

import contextlib
import io
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

from accountloom.schemas import SOURCE_COLUMNS, source_schema

TESTDATA = "/root/testdata/sf0.001"


def rows(df: DataFrame) -> Counter:
    return Counter(tuple(r) for r in df.collect())


def value_of(spark: SparkSession, column, **inputs):
    """The column evaluated on one row of text inputs."""
    schema = ", ".join(f"{n} string" for n in inputs)
    return spark.createDataFrame([tuple(inputs.values())], schema).select(column).first()[0]


def source(spark: SparkSession, entity: str, *records: dict) -> DataFrame:
    """A source frame; columns a record leaves out are NULL."""
    data = [tuple(r.get(c) for c in SOURCE_COLUMNS[entity]) for r in records]
    return spark.createDataFrame(data, source_schema(entity))


def plan(df: DataFrame, mode: str = "formatted") -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


@contextlib.contextmanager
def settings(spark: SparkSession, **values: str):
    """Session settings for a block; dots in names are written as two underscores."""
    named = {n.replace("__", "."): v for n, v in values.items()}
    before = {n: spark.conf.get(n, None) for n in named}
    for n, v in named.items():
        spark.conf.set(n, v)
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)
