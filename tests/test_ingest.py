from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

import coursetide as ct
from coursetide.fixtures import as_records, lms_events
from coursetide.schemas import BRONZE

from .conftest import TESTDATA
from .rows import event, record, records_of

KEPT = [name for name in BRONZE.names if name != "ingest_time"]


@pytest.fixture
def folders(tmp_path):
    class Folders:
        log, bronze, checkpoint = (str(tmp_path / name) for name in ("log", "bronze", "checkpoint"))

    return Folders


def add_to_log(spark, folders, *values, first_offset=0):
    rows = [record(value, offset=first_offset + n) for n, value in enumerate(values)]
    records_of(spark, rows).coalesce(1).write.mode("append").parquet(folders.log)


def catch_up(spark, folders, gather_days=False, **options):
    raw = ct.replay_records(spark, folders.log, **options)
    query = ct.ingest(raw, folders.bronze, folders.checkpoint, catch_up=True, gather_days=gather_days)
    query.awaitTermination()
    return query


def test_batch_and_stream_agree(spark, folders):
    events = lms_events(spark, str(TESTDATA / "sf0.001"))
    as_records(events).repartition(6).write.parquet(folders.log)
    query = catch_up(spark, folders, files_per_trigger=2)
    assert len([p for p in query.recentProgress if p.numInputRows > 0]) == 3
    streamed = ct.read_bronze(spark, folders.bronze).select(*KEPT)
    batch = ct.parse_events(as_records(events)).select(*KEPT)
    mapped = events.select(*KEPT)
    assert streamed.count() == events.count()
    for other in (batch, mapped):
        assert streamed.exceptAll(other).isEmpty() and other.exceptAll(streamed).isEmpty()


@pytest.mark.parametrize("gather", [True, False])
def test_files_of_a_batch(spark, folders, tmp_path, gather):
    events = lms_events(spark, str(TESTDATA / "sf0.001")).where("event_date < '2024-01-04'")
    as_records(events).repartition(4).write.parquet(folders.log)
    raw = ct.replay_records(spark, folders.log)
    ct.ingest(raw, folders.bronze, folders.checkpoint, catch_up=True, gather_days=gather).awaitTermination()
    files = len(list((tmp_path / "bronze").glob("event_date=*/*.parquet")))
    assert files == 3 if gather else files > 3
    assert ct.read_bronze(spark, folders.bronze).count() == events.count()


def test_a_large_day_of_a_batch_is_cut(spark, folders, tmp_path):
    events = lms_events(spark, str(TESTDATA / "sf0.01"))
    one_day = as_records(events.withColumn("timestamp_iso", F.lit("2024-01-15T00:00:00Z")))
    one_day.repartition(8).write.parquet(folders.log)
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "64k")
    try:
        catch_up(spark, folders, gather_days=True)
    finally:
        spark.conf.unset(setting)
    assert len(list((tmp_path / "bronze" / "event_date=2024-01-15").glob("*.parquet"))) > 1
    assert ct.read_bronze(spark, folders.bronze).count() == events.count()


def test_restart_takes_up_where_it_stopped(spark, folders):
    add_to_log(spark, folders, event("1"), event("2"))
    catch_up(spark, folders)
    catch_up(spark, folders)
    assert ct.read_bronze(spark, folders.bronze).count() == 2
    add_to_log(spark, folders, event("3"), first_offset=2)
    catch_up(spark, folders)
    ids = [r.event_id for r in ct.read_bronze(spark, folders.bronze).orderBy("event_id").collect()]
    assert ids == ["1", "2", "3"]


def test_unreadable_and_late_records(spark, folders, tmp_path):
    add_to_log(spark, folders, event("1"), "garbage")
    catch_up(spark, folders)
    add_to_log(spark, folders, event("late", iso="2024-12-01T00:00:00Z"), first_offset=2)
    catch_up(spark, folders)
    days = {p.name for p in (tmp_path / "bronze").glob("event_date=*")}
    assert days == {
        "event_date=2025-01-02",
        "event_date=2024-12-01",
        "event_date=__HIVE_DEFAULT_PARTITION__",
    }
    bronze = ct.read_bronze(spark, folders.bronze)
    assert bronze.where("event_date IS NULL").count() == 1
    assert [r.event_date for r in ct.user_progress_between(bronze).orderBy("event_date").collect()] == [
        date(2024, 12, 1),
        date(2025, 1, 2),
    ]


def test_a_failed_batch_is_repeated_once(spark, folders):
    add_to_log(spark, folders, *(event(str(n)) for n in range(10)))
    add_to_log(spark, folders, *(event(str(n)) for n in range(10, 20)), first_offset=10)
    raw = ct.replay_records(spark, folders.log, files_per_trigger=1)
    lost = F.when(F.col("offset") == 15, F.raise_error(F.lit("task lost"))).otherwise(F.col("value"))
    with pytest.raises(Exception, match="task lost"):
        ct.ingest(
            raw.withColumn("value", lost), folders.bronze, folders.checkpoint, catch_up=True
        ).awaitTermination()
    assert ct.read_bronze(spark, folders.bronze).count() in (0, 10)
    catch_up(spark, folders, files_per_trigger=1)
    ids = [r.event_id for r in ct.read_bronze(spark, folders.bronze).collect()]
    assert sorted(ids, key=int) == [str(n) for n in range(20)]


def test_a_day_run_again_takes_up_late_records(spark, folders, tmp_path):
    silver_path = str(tmp_path / "silver")
    add_to_log(spark, folders, event("1"))
    catch_up(spark, folders)
    ct.run_day(spark, folders.bronze, silver_path, "2025-01-02")
    add_to_log(spark, folders, event("late"), first_offset=1)
    catch_up(spark, folders)
    assert ct.read_silver(spark, silver_path).first().total_activities == 1
    ct.run_day(spark, folders.bronze, silver_path, "2025-01-02")
    assert [r.total_activities for r in ct.read_silver(spark, silver_path).collect()] == [2]


def test_interval_trigger(spark, folders):
    add_to_log(spark, folders, event("1"))
    raw = ct.replay_records(spark, folders.log)
    query = ct.ingest(raw, folders.bronze, folders.checkpoint, every="1 second")
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert ct.read_bronze(spark, folders.bronze).count() == 1


def test_stream_to_silver_end_to_end(spark, folders, tmp_path):
    add_to_log(
        spark,
        folders,
        event("1", "video_started", payload={"video_id": "v1", "position_seconds": 0}),
        event("2", "video_completed", payload={"video_id": "v1", "watch_seconds": 60}),
        "garbage",
    )
    catch_up(spark, folders)
    silver_path = str(tmp_path / "silver")
    ct.run_day(spark, folders.bronze, silver_path, "2025-01-02")
    [row] = ct.read_silver(spark, silver_path).collect()
    assert (row.user_id, row.total_watch_seconds, row.video_completion_rate_percent) == ("u1", 60, 50.0)
    health = ct.pipeline_health(ct.read_bronze(spark, folders.bronze), ct.read_silver(spark, silver_path))
    assert health.first().status == "NEEDS_ATTENTION"
