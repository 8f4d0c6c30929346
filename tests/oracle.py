"""Comparison of a Spark result with DuckDB's on the same files."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def duckdb_on(folder: Path) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(folder.glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def assert_same(spark_df, connection, sql: str) -> int:
    rows = [tuple(row) for row in spark_df.collect()]
    cursor = connection.execute(sql)
    columns = [column[0] for column in cursor.description]
    assert sorted(spark_df.columns) == sorted(columns)
    expected = cursor.fetchall()
    assert _bag(spark_df.columns, rows) == _bag(columns, expected)
    return len(rows)
