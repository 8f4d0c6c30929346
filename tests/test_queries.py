"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry

from .conftest import TESTDATA
from .oracle import assert_same, duckdb_on

FOLDER = TESTDATA / "sf0.01"
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duckdb_on(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.analytics_queries()))
def test_query_equals_sql(spark, connection, name):
    result = registry.queries()[name](spark, str(FOLDER))
    assert assert_same(result, connection, SQL[name]) > 0


def test_every_query_has_sql():
    assert registry.analytics_queries().keys() <= SQL.keys() <= registry.queries().keys()


def test_entry(spark):
    result = registry.entry(spark)
    assert result.count() > 0
    assert "completion_score" in result.columns
