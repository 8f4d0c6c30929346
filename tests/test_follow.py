"""Late rows reach silver through the days that batches touch."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

import coursetide as ct
from coursetide.schemas import SILVER
from coursetide.streaming import follow

from .rows import event, record, records_of

VALUES = [name for name in SILVER.names if not name.startswith("processing_")]
DAYS = [date(2025, 1, n) for n in range(1, 6)]


@pytest.fixture
def folders(tmp_path):
    class Folders:
        log, bronze, silver, ingested, followed = (str(tmp_path / n) for n in ("log", "bronze", "silver", "in", "follow"))

    return Folders


def arrive(spark, folders, *events):
    """Events join the log and then bronze."""
    rows = [record(value, offset=n) for n, value in enumerate(events)]
    records_of(spark, rows).coalesce(1).write.mode("append").parquet(folders.log)
    ct.ingest(ct.replay_records(spark, folders.log), folders.bronze, folders.ingested, catch_up=True).awaitTermination()


def follow_up(spark, folders, **options):
    query = ct.follow_silver(spark, folders.bronze, folders.silver, folders.followed, catch_up=True, **options)
    query.awaitTermination()
    return query


def on(day, n, **more):
    return event(f"{day}-{n}", iso=f"{day}T10:00:00Z", **more)


def values(df):
    return sorted(map(str, df.select(*VALUES).collect()))


def stored(spark, folders):
    return values(ct.read_silver(spark, folders.silver))


def whole(spark, folders):
    return values(ct.user_progress_between(ct.read_bronze(spark, folders.bronze)))


def runs(spark, folders):
    """The time at which each day was made."""
    table = ct.read_silver(spark, folders.silver).groupBy("event_date").agg(F.max("processing_timestamp").alias("t"))
    return {r.event_date: r.t for r in table.collect()}


@pytest.fixture
def published(monkeypatch):
    """The days of each publishing, which fails as often as is asked for: after the work is done."""
    calls, failures = [], []
    publish = follow.publish_days

    def counted(silver, path, days, *rest):
        publish(silver, path, days, *rest)
        calls.append(list(days))
        if failures:
            raise RuntimeError(failures.pop())

    monkeypatch.setattr(follow, "publish_days", counted)
    return calls, failures


def test_late_rows_change_their_day_only(spark, folders, published):
    arrive(spark, folders, *(on(day, 1) for day in DAYS[:3]))
    follow_up(spark, folders)
    before = runs(spark, folders)
    arrive(spark, folders, on(DAYS[0], 2), on(DAYS[3], 1), "no event", on(DAYS[0], 3, kind="quiz_submitted", payload={"score": 70.0}))
    follow_up(spark, folders)
    after = runs(spark, folders)
    assert published[0] == [DAYS[:3], [DAYS[0], DAYS[3]]]
    assert stored(spark, folders) == whole(spark, folders)
    assert sorted(day for day in before if after[day] == before[day]) == DAYS[1:3]


def test_nothing_new_does_nothing(spark, folders, published):
    arrive(spark, folders, on(DAYS[0], 1))
    follow_up(spark, folders)
    follow_up(spark, folders)
    assert published[0] == [[DAYS[0]]]


def test_rows_without_a_day_touch_none(spark, folders, published):
    arrive(spark, folders, "no event")
    follow_up(spark, folders)
    assert published[0] == []


def test_a_batch_that_failed_is_worked_off_again(spark, folders, published):
    calls, failures = published
    arrive(spark, folders, on(DAYS[0], 1), on(DAYS[1], 1))
    failures.append("lost after publishing")
    with pytest.raises(StreamingQueryException):
        follow_up(spark, folders)
    arrive(spark, folders, on(DAYS[0], 2))
    follow_up(spark, folders)
    assert calls == [DAYS[:2], DAYS[:2], [DAYS[0]]]
    assert stored(spark, folders) == whole(spark, folders)


def test_a_finished_batch_is_passed_over(spark, folders, published, tmp_path):
    """Its mark was written, and then the driver was lost before Spark noted the batch as done."""
    arrive(spark, folders, on(DAYS[0], 1))
    follow_up(spark, folders)
    commit = tmp_path / "follow" / "commits" / "0"
    commit.unlink()
    (tmp_path / "follow" / "commits" / ".0.crc").unlink(missing_ok=True)
    before = runs(spark, folders)
    follow_up(spark, folders)
    assert published[0] == [[DAYS[0]]] and runs(spark, folders) == before
    assert commit.exists()


def test_another_query_does_not_rely_on_the_marks_of_the_first(spark, folders, published, tmp_path):
    arrive(spark, folders, on(DAYS[0], 1))
    follow_up(spark, folders)
    folders.followed = str(tmp_path / "second")
    follow_up(spark, folders)
    assert published[0] == [[DAYS[0]], [DAYS[0]]]


def test_batches_by_number_of_files(spark, folders, published):
    for day in DAYS:
        arrive(spark, folders, on(day, 1), on(DAYS[0], day.day + 10))
    follow_up(spark, folders, files_per_trigger=2)
    assert len(published[0]) > 2
    assert stored(spark, folders) == whole(spark, folders)


def test_further_tables_are_kept_up(spark, folders):
    told = []
    arrive(spark, folders, on(DAYS[0], 1), on(DAYS[1], 1))
    follow_up(spark, folders, also=lambda rows, days: told.append((rows.count(), days)))
    assert told == [(2, DAYS[:2])]


def test_publish_days_replaces_those_days(spark, folders):
    arrive(spark, folders, *(on(day, 1) for day in DAYS))
    bronze = ct.read_bronze(spark, folders.bronze)
    ct.publish_days(ct.user_progress_between(bronze), folders.silver, DAYS)
    before = stored(spark, folders)
    ct.publish_days(ct.user_progress_between(bronze), folders.silver, [])
    assert stored(spark, folders) == before
    ct.publish_days(ct.user_progress_on(bronze, [DAYS[1]]), folders.silver, [DAYS[1], DAYS[3]])
    days = sorted(r.event_date for r in ct.read_silver(spark, folders.silver).collect())
    assert days == [DAYS[0], DAYS[1], DAYS[2], DAYS[4]]
