"""Queries that SQL can express give exactly its result."""

from __future__ import annotations

import os

import duckdb
import pytest
from compare import differences

from shelftide.llm import queries


@pytest.fixture(scope="module")
def con(folder):
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "conversations"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{os.path.join(folder, name)}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_result_as_sql(spark, con, folder, name):
    assert differences(queries.QUERIES[name](spark, folder), con, queries.SQL[name]) == []
