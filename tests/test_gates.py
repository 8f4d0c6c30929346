"""Checks that come out of the jobs themselves, without reading a table for them."""

from __future__ import annotations

from datetime import date

import pytest

import coursetide as ct

from .rows import DAY, bronze_of, bronze_row, event, record, records_of
from .test_tables import NEXT, silver_of, stored


@pytest.fixture
def folders(spark, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    rows = [bronze_row("article_viewed", user=u) for u in ("a", "a", "b")]
    bronze_of(spark, rows).write.partitionBy("event_date").parquet(bronze)
    return bronze, silver


def executions(spark):
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return spark._jsparkSession.sharedState().statusStore().executionsCount()


def test_a_daily_run_is_one_job(spark, folders):
    """Before, it read bronze for a row, listed the day's files twice, and read silver for a row."""
    bronze, silver = folders
    before = executions(spark)
    ct.run_day(spark, bronze, silver, DAY)
    assert executions(spark) - before == 1
    assert stored(spark, silver) == [(DAY, "a"), (DAY, "b")]


def test_a_day_without_events_leaves_silver(spark, folders):
    bronze, silver = folders
    ct.publish(silver_of(spark, ("kept", NEXT)), silver, NEXT)
    with pytest.raises(LookupError, match="no rows for event_date=2025-01-03"):
        ct.run_day(spark, bronze, silver, NEXT)
    assert stored(spark, silver) == [(NEXT, "kept")]


def test_a_day_whose_rows_were_lost_on_the_way_leaves_silver(spark, folders, monkeypatch):
    bronze, silver = folders
    ct.publish(silver_of(spark, ("kept", DAY)), silver, DAY)
    from coursetide.plans import daily

    monkeypatch.setattr(daily, "user_progress", lambda events, day: ct.user_progress(events, day).where("user_id = 'nobody'"))
    with pytest.raises(LookupError, match="no silver rows"):
        ct.run_day(spark, bronze, silver, DAY)
    assert stored(spark, silver) == [(DAY, "kept")]


def test_publishing_one_day_does_not_list_files(spark, folders):
    _, silver = folders
    before = executions(spark)
    ct.publish(silver_of(spark, ("a", DAY)), silver, DAY)
    assert executions(spark) - before == 1


def test_a_single_day_can_still_be_emptied(spark, folders):
    _, silver = folders
    ct.publish(silver_of(spark, ("a", DAY), ("b", NEXT)), silver, DAY)
    ct.publish(silver_of(spark, ("b", NEXT)), silver, NEXT)
    ct.publish(silver_of(spark), silver, DAY)
    assert stored(spark, silver) == [(NEXT, "b")]
    ct.publish_days(silver_of(spark), silver, [NEXT])
    assert stored(spark, silver) == []


def test_counts_of_a_stream(spark, tmp_path):
    log, bronze, checkpoint = (str(tmp_path / n) for n in ("log", "bronze", "checkpoint"))
    days = [date(2025, 1, n) for n in (2, 3, 1)]
    for day in days:
        rows = [record(event(str(day), iso=f"{day}T10:00:00Z")), record("garbage")]
        records_of(spark, rows).coalesce(1).write.mode("append").parquet(log)
    raw = ct.replay_records(spark, log, files_per_trigger=1)
    query = ct.ingest(raw, bronze, checkpoint, catch_up=True)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3
    assert ct.ingested(query) == {"records": 6, "without_day": 3, "latest_event": "2025-01-03T10:00:00Z"}
    again = ct.ingest(raw, bronze, checkpoint, catch_up=True)
    again.awaitTermination()
    assert ct.ingested(again) == {"records": 0, "without_day": 0, "latest_event": None}
