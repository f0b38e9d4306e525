"""The queries that have SQL against it on DuckDB, over the same tables."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

from accountloom.llm.queries import llm_oracles, llm_queries
from tests.llm.support import SF

TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", llm_oracles())
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for file in sorted(os.listdir(SF)):
        duck.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    wanted = duck.sql(llm_oracles()[name])
    found = llm_queries()[name](spark, SF)
    assert {c: TYPES[t] for c, t in found.dtypes} == dict(zip(wanted.columns, map(str, wanted.types)))
    columns = ", ".join(f'"{c}"' for c in found.columns)
    rows = duck.sql(f"SELECT {columns} FROM ({llm_oracles()[name]})").fetchall()
    assert Counter(map(tuple, found.collect())) == Counter(rows) and rows
