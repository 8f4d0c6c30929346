"""KPIs and distinct counts from day tables against the same ones from rows."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import coursetide as ct
from coursetide.fixtures import lms_events
from coursetide.schemas import NUMBERS

from .conftest import TESTDATA
from .rows import DAY, bronze_of, bronze_row

NEXT = DAY + timedelta(days=1)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "tables")


def refresh(bronze, root, *days):
    ct.refresh_day_tables(bronze, ct.user_progress_between(bronze), root, days)


def rows(df):
    return [tuple(r) for r in df.collect()]


ROWS = [
    bronze_row("course_enrolled", user="a", course="c1"),
    bronze_row("course_enrolled", user="b", course=None),
    bronze_row("quiz_submitted", user="a", course="c1", score=70.0, passed=True),
    bronze_row("quiz_submitted", user="b", course="c1", score=None),
    bronze_row("quiz_submitted", user="b", course="c2", score=None),
    bronze_row("video_completed", user="a", video_id="v1", watch_seconds=50),
    bronze_row("video_completed", user=None, video_id=None, watch_seconds=None),
    bronze_row("video_completed", user="c", video_id="v1", watch_seconds=25, day=NEXT),
    bronze_row("quiz_submitted", user="c", course="c1", score=81.0, day=NEXT),
    bronze_row("article_viewed", user="a", day=NEXT),
    bronze_row("something_else", user="a", course="c9", day=NEXT),
    bronze_row(None, user=None, course=None, day=None),
    bronze_row("course_enrolled", user="z", course="c2", day=None),
]
ALL = (DAY, NEXT, None)


def assert_all_agree(bronze, root):
    """Every reader against its plain counterpart over all rows."""
    silver = ct.user_progress_between(bronze)
    states, bitmaps = ct.read_day_tables(bronze.sparkSession, root)
    merged, distinct = ct.merge_states(states), ct.distinct_counts(bitmaps)
    assert rows(ct.silver_kpis_of(merged)) == rows(ct.silver_kpis(silver))
    assert rows(ct.engagement_distribution_of(merged)) == rows(ct.engagement_distribution(silver))
    assert rows(ct.events_by_type_of(merged)) == rows(ct.events_by_type(bronze))
    assert rows(ct.top_courses_of(merged)) == rows(ct.top_courses(bronze))
    assert rows(ct.avg_quiz_score_per_course_of(merged)) == rows(ct.avg_quiz_score_per_course(bronze))
    assert rows(ct.most_watched_videos_of(merged)) == rows(ct.most_watched_videos(bronze))
    assert rows(ct.pipeline_health_of(merged, distinct)) == rows(ct.pipeline_health(bronze, silver))


def test_hand_written_rows(spark, root):
    bronze = bronze_of(spark, ROWS)
    refresh(bronze, root, *ALL)
    assert_all_agree(bronze, root)


def test_days_that_are_replaced(spark, root):
    refresh(bronze_of(spark, ROWS[:5] + ROWS[7:9]), root, *ALL)
    refresh(bronze_of(spark, ROWS), root, *ALL)
    refresh(bronze_of(spark, ROWS[3:]), root, DAY)  # three rows of it are gone again
    assert_all_agree(bronze_of(spark, ROWS[3:]), root)


def test_a_day_that_lost_its_rows(spark, root):
    refresh(bronze_of(spark, ROWS), root, *ALL)
    left = bronze_of(spark, [r for r in ROWS if DAY not in r])
    refresh(left, root, DAY)
    assert_all_agree(left, root)
    left = bronze_of(spark, [r for r in ROWS if NEXT in r])
    refresh(left, root, None)
    assert_all_agree(left, root)


def test_repeating_changes_nothing(spark, root):
    bronze = bronze_of(spark, ROWS)
    for _ in range(2):
        refresh(bronze, root, *ALL)
    assert_all_agree(bronze, root)
    numbers = ct.read_numbers(spark, f"{root}/numbers")
    assert numbers.count() == numbers.select("column_name", "value").distinct().count() == 5 + 4 + 3


def test_ranges(spark, root):
    bronze = lms_events(spark, str(TESTDATA / "sf0.001")).cache()
    days = [r.event_date for r in bronze.select("event_date").distinct().collect()]
    refresh(bronze, root, *days)
    states, bitmaps = ct.read_day_tables(spark, root)
    for start, end in ((None, date(2024, 1, 7)), (date(2024, 1, 9), "2024-01-12"), ("2024-01-20", None), ("2031-01-01", None)):
        part = bronze.where(F.col("event_date").between(F.lit(start or date(2000, 1, 1)), F.lit(end or date(2030, 1, 1)).cast("date")))
        merged = ct.merge_states(states, start, end)
        assert rows(ct.most_watched_videos_of(merged, 5)) == rows(ct.most_watched_videos(part, 5))
        assert rows(ct.avg_quiz_score_per_course_of(merged)) == rows(ct.avg_quiz_score_per_course(part))
        silver = ct.user_progress_between(part)
        assert rows(ct.silver_kpis_of(merged)) == rows(ct.silver_kpis(silver))
        assert rows(ct.pipeline_health_of(merged, ct.distinct_counts(bitmaps, start, end))) == rows(ct.pipeline_health(part, silver))
    bronze.unpersist()


def test_an_empty_bronze(spark, root):
    empty = bronze_of(spark, [])
    refresh(empty, root, DAY)
    assert_all_agree(empty, root)


def test_more_values_than_a_bitmap_holds(spark, root):
    """Users over three bitmaps, most of them on both days."""
    many = spark.range(70_000).select(F.concat(F.lit("u"), "id").alias("user_id"), (F.col("id") % 3).alias("k"))
    bronze = many.withColumn("event_date", F.explode(F.array(F.lit(DAY), F.lit(NEXT)))).where(
        (F.col("event_date") == F.lit(DAY)) | (F.col("k") > 0)
    )
    ct.grow_numbers(bronze.where("k < 2"), root, ["user_id"])
    first = {r.value: r.number for r in ct.read_numbers(spark, root).collect()}
    ct.grow_numbers(bronze, root, ["user_id"])
    numbers = {r.value: r.number for r in ct.read_numbers(spark, root).collect()}
    assert first.items() <= numbers.items()
    assert sorted(numbers.values()) == list(range(1, 70_001))
    bitmaps = ct.day_bitmaps(bronze, ct.read_numbers(spark, root), ["user_id"])
    assert rows(ct.distinct_counts(bitmaps)) == [("user_id", 70_000)]
    assert [r[2] for r in rows(ct.distinct_by_day(bitmaps))] == [70_000, 70_000 - 23_334]
    assert bitmaps.select("bucket").distinct().count() == 3


def test_a_value_without_a_number_is_not_passed_over(spark):
    bronze = bronze_of(spark, ROWS[:1])
    with pytest.raises(Exception, match="has no number"):
        ct.day_bitmaps(bronze, spark.createDataFrame([], NUMBERS)).collect()


def test_counts_do_not_shuffle_values(spark, root):
    """What a range is counted from is a row per column and 32,768 values, and rankings take states."""
    refresh(bronze_of(spark, ROWS), root, *ALL)
    states, bitmaps = ct.read_day_tables(spark, root)
    plan = ct.distinct_counts(bitmaps, DAY, DAY)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "ReadSchema: struct<column_name:string,bucket:bigint,bits:binary>" in plan
    plan = ct.top_courses_of(ct.merge_states(states, DAY, DAY))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "course_enrolled" in plan.split("PushedFilters")[1]


def test_the_stream_keeps_them_up(spark, tmp_path, root):
    from .test_follow import arrive, on

    class Folders:
        log, bronze, ingested = (str(tmp_path / n) for n in ("log", "bronze", "in"))

    silver = str(tmp_path / "silver")

    def follow():
        query = ct.follow_silver(
            spark, Folders.bronze, silver, str(tmp_path / "check"), catch_up=True, also=ct.refresher(silver, root)
        )
        query.awaitTermination()

    arrive(spark, Folders, on(DAY, 1), on(NEXT, 1, kind="course_enrolled"))
    follow()
    arrive(spark, Folders, on(DAY, 2, kind="quiz_submitted", payload={"score": 50.0}), "no event")
    follow()
    bronze = ct.read_bronze(spark, Folders.bronze)
    states, bitmaps = ct.read_day_tables(spark, root)
    merged = ct.merge_states(states)
    assert rows(ct.events_by_type_of(merged)) == rows(ct.events_by_type(bronze))
    health = ct.pipeline_health_of(merged, ct.distinct_counts(bitmaps))
    assert rows(health) == rows(ct.pipeline_health(bronze, ct.read_silver(spark, silver)))
