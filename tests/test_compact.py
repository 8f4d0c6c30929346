"""Compacted days hold the same rows in fewer files, survive late files and serve filters with fewer row groups."""

from __future__ import annotations

from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

import coursetide as ct
from coursetide.fixtures import as_records, lms_events
from coursetide.schemas import BRONZE
from coursetide.sources import curve

from .conftest import TESTDATA
from .rows import event, record, records_of

KEPT = [name for name in BRONZE.names if name != "ingest_time"]
END = "2024-02-01"


@pytest.fixture
def folders(tmp_path):
    class Folders:
        root = tmp_path
        log, bronze, checkpoint, compact = (str(tmp_path / n) for n in ("log", "bronze", "checkpoint", "compact"))

    return Folders


def arrive(spark, folders, records, files=6, per_trigger=2):
    records.repartition(files).write.mode("append").parquet(folders.log)
    raw = ct.replay_records(spark, folders.log, files_per_trigger=per_trigger)
    ct.ingest(raw, folders.bronze, folders.checkpoint, catch_up=True).awaitTermination()


def bag(df):
    return Counter(map(str, df.select(*KEPT).collect()))


def files_by_day(df, of=""):
    """Spark lists a table's files whatever its filters are, so ``of`` picks those of one of the tables."""
    return Counter(name.split("event_date=")[1].split("/")[0] for name in df.inputFiles() if of in name)


@pytest.mark.parametrize("cluster_by", [(), ("event_type", "course_id", "user_id")])
def test_same_rows_in_fewer_files(spark, folders, cluster_by):
    events = lms_events(spark, str(TESTDATA / "sf0.001"))
    arrive(spark, folders, as_records(events).unionByName(records_of(spark, [record("garbage")])))
    live = ct.read_bronze(spark, folders.bronze)
    assert max(files_by_day(live).values()) > 2
    done = ct.compact_days(spark, folders.bronze, folders.compact, "2024-01-20", cluster_by=cluster_by)
    assert done == [None] + [date(2024, 1, n) for n in range(1, 20)]
    both = ct.read_compacted(spark, folders.bronze, folders.compact)
    assert both.columns == BRONZE.names and bag(both) == bag(live)
    count = files_by_day(both, "/compact/")
    assert [count[f"2024-01-{n:02}"] for n in range(1, 20)] == [1] * 19 and count["2024-01-20"] == 0


def test_files_are_bounded_by_bytes(spark, folders):
    arrive(spark, folders, as_records(lms_events(spark, str(TESTDATA / "sf0.001"))).where("timestamp < '2024-01-03'"))
    live = ct.read_bronze(spark, folders.bronze)
    sizes = {f: n for f, n in live.select("_metadata.file_path", "_metadata.file_size").distinct().collect()}
    bound = 2 * max(sizes.values())
    ct.compact_days(spark, folders.bronze, folders.compact, END, cluster_by=(), file_bytes=bound)
    both = ct.read_compacted(spark, folders.bronze, folders.compact)
    for day, count in files_by_day(both, "/compact/").items():
        held = sum(n for f, n in sizes.items() if day in f)
        assert held / bound <= count <= 2 * held / bound + 1
        assert count < sum(day in f for f in sizes)
    assert bag(both) == bag(live)


def test_a_repeated_run_does_nothing(spark, folders):
    arrive(spark, folders, records_of(spark, [record(event("1", iso="2024-01-05T00:00:00Z"))]), files=1)
    assert ct.compact_days(spark, folders.bronze, folders.compact, END) == [date(2024, 1, 5)]
    before = sorted(folders.root.glob("compact/**/*.parquet"))
    assert ct.compact_days(spark, folders.bronze, folders.compact, END) == []
    assert sorted(folders.root.glob("compact/**/*.parquet")) == before


def test_late_rows_are_read_before_and_after_the_next_compaction(spark, folders):
    arrive(spark, folders, records_of(spark, [record(event(str(n), iso=f"2024-01-0{n}T00:00:00Z")) for n in (1, 2, 3)]), files=1)
    ct.compact_days(spark, folders.bronze, folders.compact, END)
    old = ct.read_compacted(spark, folders.bronze, folders.compact)
    arrive(spark, folders, records_of(spark, [record(event("late", iso="2024-01-02T00:00:00Z"))]), files=1)
    live = ct.read_bronze(spark, folders.bronze)
    assert bag(ct.read_compacted(spark, folders.bronze, folders.compact)) == bag(live)
    assert ct.compact_days(spark, folders.bronze, folders.compact, END) == [date(2024, 1, 2)]
    both = ct.read_compacted(spark, folders.bronze, folders.compact)
    assert bag(both) == bag(live) and all("/compact/" in f for f in both.inputFiles())
    assert old.count() == 3  # a reader from before the swap still has its files


def test_a_failed_run_leaves_what_was(spark, folders, monkeypatch):
    arrive(spark, folders, records_of(spark, [record(event("1", iso="2024-01-05T00:00:00Z"))]), files=1)
    from coursetide.sources import compact

    def lost(columns):
        return F.raise_error(F.lit("task lost")).cast("long")

    monkeypatch.setattr(compact, "curve", lost)
    with pytest.raises(Exception, match="task lost"):
        ct.compact_days(spark, folders.bronze, folders.compact, END)
    monkeypatch.undo()
    both = ct.read_compacted(spark, folders.bronze, folders.compact)
    assert both.count() == 1 and all("/compact/" not in f for f in both.inputFiles())
    assert ct.compact_days(spark, folders.bronze, folders.compact, END) == [date(2024, 1, 5)]


def scanned(df):
    """Rows that the scan hands on, after row groups and pages were passed over by their statistics."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    todo, total = [plan], 0
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan"):
            total += node.metrics().apply("numOutputRows").value()
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return total


def test_filters_within_a_day_meet_fewer_row_groups(spark, folders):
    """A user, a course and a type, over the same rows in order of arrival and clustered."""
    events = lms_events(spark, str(TESTDATA / "sf0.1")).withColumn("timestamp_iso", F.lit("2024-01-05T00:00:00Z"))
    arrive(spark, folders, as_records(events), files=4, per_trigger=4)
    small = {"group_bytes": 1 << 16, "file_bytes": 1 << 20}
    ct.compact_days(spark, folders.bronze, folders.compact, END, cluster_by=(), **small)
    ct.compact_days(spark, folders.bronze, folders.compact + "2", END, **small)
    plain, clustered = (ct.read_compacted(spark, folders.bronze, folders.compact + n) for n in ("", "2"))
    row = events.first()
    for column, share in (("user_id", 0.5), ("course_id", 0.5), ("event_type", 0.5)):
        wanted = F.col(column) == row[column]
        assert plain.where(wanted).count() == clustered.where(wanted).count() > 0
        before, after = (scanned(df.where(wanted).select("event_id")) for df in (plain, clustered))
        assert after <= share * before, (column, before, after)


def test_curve_interleaves_all_bits(spark):
    rows = spark.range(3000).select(F.col("id").alias("a"), (F.col("id") * 7).alias("b"))
    places = {r[0] for r in rows.select(curve(["a", "b"])).collect()}
    assert 0 <= min(places) and max(places) < 1 << 20 and len(places) > 2900
    same = rows.select(curve(["a"]).alias("c"), F.pmod(F.xxhash64("a"), F.lit(1024)).alias("h")).where("c <> h")
    assert same.isEmpty()
