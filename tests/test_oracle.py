"""Registered queries against their SQL in DuckDB, on the smallest given tables."""

from __future__ import annotations

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import connect, difference

import workload
from workload.registry import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="given tables are absent")

workload.load()


@pytest.fixture(scope="module")
def duckdb_tables():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duckdb_tables, name):
    assert difference(queries()[name](spark, SF_DIR), duckdb_tables, oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries())
    assert set(ORACLE) <= set(oracle_sql())


def test_entry(spark):
    result = entry(spark)
    assert result.columns[-1] == "total_profit"
    assert result.count() > 0
