"""Every query against its SQL on DuckDB, over the same tables."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from accountloom.queries import all_queries
from sqlcheck.oracles import all_oracles
from tests.support import TESTDATA, rows

TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
}

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(os.listdir(TESTDATA)):
        name = file.removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{TESTDATA}/{file}'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, duck, name):
    ours = QUERIES[name](spark, TESTDATA)
    columns = sorted(ours.columns)
    expected = duck.sql(ORACLES[name])
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: TYPES[t] for c, t in ours.dtypes} == types
    names = ", ".join(f'"{c}"' for c in columns)
    wanted = duck.sql(f"SELECT {names} FROM ({ORACLES[name]})").fetchall()
    got = rows(ours.select(columns))
    assert got == Counter(wanted)
    assert sum(got.values()) > 0


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0
