"""Sketches against exact figures, within the errors they promise."""

from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

import coursetide as ct
from coursetide.fixtures import lms_events
from coursetide.operators import sketches
from coursetide.schemas import SKETCHES

from .conftest import TESTDATA
from .rows import DAY, bronze_of, bronze_row

NEXT = DAY + timedelta(days=1)


def profile(df, *range_):
    return {r.column_name: r for r in ct.profile_of(ct.merge_sketches(df, *range_)).collect()}


def exact(table, source, number):
    values = sorted(r.v for r in table.select(F.col(source).alias("v")).where("v is not null").collect())
    return values, len(set(values))


@pytest.fixture(scope="module")
def bronze(spark):
    table = lms_events(spark, str(TESTDATA / "sf0.1")).cache()
    yield table
    table.unpersist()


@pytest.mark.parametrize("days", [(None, None), ("2024-01-05", "2024-01-16"), ("2024-01-09", "2024-01-09")])
def test_within_the_promised_errors(spark, bronze, tmp_path, days):
    path = str(tmp_path / "sketches")
    ct.publish_between(ct.day_sketches(bronze), path, "2024-01-01", "2024-02-01")
    stored = spark.read.schema(SKETCHES).parquet(path)
    start, end = (days[0] or "2000-01-01", days[1] or "2030-01-01")
    part = bronze.where(F.col("event_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    found, records = profile(stored, *days), part.count()
    assert found.keys() == sketches.PROFILED.keys()
    for name, (source, number) in sketches.PROFILED.items():
        values, distinct = exact(part, source, number)
        row = found[name]
        assert (row.records, row.nulls) == (records, records - len(values))
        assert abs(row.distinct_values - distinct) <= max(1, sketches.DISTINCT_ERROR * distinct)
        if not number:
            assert row.least is row.greatest is row.median is None
            continue
        assert (row.least, row.greatest) == (values[0], values[-1])
        for label, q in sketches.QUANTILES.items():
            # the rank of what was given, which a run of equal values may stretch
            below = sum(v < row[label] for v in values) / len(values)
            above = sum(v <= row[label] for v in values) / len(values)
            assert below - sketches.RANK_ERROR <= q <= above + sketches.RANK_ERROR


def test_few_rows_nulls_and_a_missing_day(spark):
    rows = [
        bronze_row("quiz_submitted", user="a", score=10.0),
        bronze_row("quiz_submitted", user="b", score=30.0),
        bronze_row("quiz_submitted", user="b", score=20.0, day=NEXT),
        bronze_row(None, user=None, course=None, day=None),
    ]
    df = ct.day_sketches(bronze_of(spark, rows))
    assert {r.event_date for r in df.collect()} == {DAY, NEXT, None}
    whole, day = profile(df), profile(df, DAY, DAY)
    assert (whole["score"].least, whole["score"].median, whole["score"].greatest, whole["score"].nulls) == (10.0, 20.0, 30.0, 1)
    assert (whole["user_id"].distinct_values, whole["user_id"].nulls, whole["user_id"].records) == (2, 1, 4)
    assert (day["score"].greatest, day["user_id"].records) == (30.0, 2)
    assert whole["video_id"].distinct_values == 0 and whole["watch_seconds"].median is None


def test_no_rows(spark):
    assert profile(ct.day_sketches(bronze_of(spark, []))) == {}
