from __future__ import annotations

from datetime import date, timedelta

import pytest

import coursetide as ct
from coursetide.functions import distinct_with_null
from coursetide.schemas import EVENT_TYPES, SILVER
from coursetide.session import yesterday_utc

from .rows import DAY, bronze_of, bronze_row


@pytest.fixture
def all_types(spark):
    return bronze_of(spark, [bronze_row(kind) for kind in EVENT_TYPES])


def tuples(df):
    return [tuple(row) for row in df.collect()]


def quiz(course, score=None, **more):
    return bronze_row("quiz_submitted", course=course, score=score, **more)


def test_silver_kpis_skip_nulls(spark):
    bronze = bronze_of(
        spark,
        [
            bronze_row("article_viewed", user="none"),
            bronze_row("video_started", user="half"),
            bronze_row("video_completed", user="half"),
            bronze_row("quiz_submitted", user="half"),
            bronze_row("video_completed", user="video"),
        ],
    )
    kpis = ct.silver_kpis(ct.user_progress(bronze, DAY))
    assert kpis.columns == ["avg_quiz_completion_%", "avg_video_completion_%", "avg_completion_score"]
    assert tuples(kpis) == [(100.0, 75.0, 75.0)]


def test_top_courses_order_ties_and_limit(spark):
    enrolled = {"b": 2, "a": 2, "c": 3, None: 1, "d": 1}
    bronze = bronze_of(
        spark,
        [bronze_row("course_enrolled", course=c) for c, n in enrolled.items() for _ in range(n)]
        + [bronze_row("article_viewed", course="d")] * 9,
    )
    assert tuples(ct.top_courses(bronze, k=3)) == [("c", 3), ("a", 2), ("b", 2)]
    assert len(tuples(ct.top_courses(bronze))) == 5


def test_events_by_type_counts_null(spark):
    bronze = bronze_of(spark, [bronze_row("b"), bronze_row(None), bronze_row("a"), bronze_row("b")])
    assert tuples(ct.events_by_type(bronze)) == [(None, 1), ("a", 1), ("b", 2)]


def test_quiz_scores_round_and_put_nulls_last(spark):
    bronze = bronze_of(
        spark, [quiz("a", 10.0), quiz("a", 10.0), quiz("a", 11.0), quiz("b", 90.0), quiz("c"), quiz("d", 90.0)]
    )
    ranking = tuples(ct.avg_quiz_score_per_course(bronze))
    assert ranking == [("b", 90.0), ("d", 90.0), ("a", 10.33), ("c", None)]


def test_watched_videos(spark):
    def watched(video, seconds):
        return bronze_row("video_completed", video_id=video, watch_seconds=seconds)

    bronze = bronze_of(
        spark,
        [watched("v1", 5), watched("v1", 6), watched("v2", 11), watched("v3", None)]
        + [bronze_row("video_started", video_id="v1", watch_seconds=99)],
    )
    assert tuples(ct.most_watched_videos(bronze)) == [("v1", 11), ("v2", 11), ("v3", None)]
    assert tuples(ct.most_watched_videos(bronze, k=1)) == [("v1", 11)]


def test_course_completion_counts_match_the_lists(spark):
    bronze = bronze_of(
        spark,
        [
            quiz("c", passed=True, user="both"),
            quiz("c", passed=False, user="both"),
            quiz("c", passed=True, user="both"),
            quiz("c", passed=False, user="failed"),
            quiz("c", user="unknown"),
            quiz("c", passed=True, user=None),
            quiz("other", passed=True, user="elsewhere"),
            quiz("c", passed=True, user="earlier", day=date(2025, 1, 1)),
            bronze_row("quiz_attempted", course="c", passed=True, user="attempt"),
        ],
    )
    strict = {r.user_id for r in ct.completed_users(bronze, "c", DAY).collect()}
    loose = {r.user_id for r in ct.completed_users(bronze, "c", DAY, strict=False).collect()}
    assert strict == {"both", None} and loose == {"both", "failed", "unknown", None}
    assert tuples(ct.course_completion(bronze, "c", DAY)) == [
        ("strict_passed", "c", len(strict)),
        ("loose_any_quiz", "c", len(loose)),
    ]


def test_course_completion_of_an_empty_day(spark):
    assert tuples(ct.course_completion(bronze_of(spark, []), "c", DAY)) == [
        ("strict_passed", "c", 0),
        ("loose_any_quiz", "c", 0),
    ]


def test_completion_day_defaults_to_yesterday(spark):
    yesterday = yesterday_utc()
    days = [yesterday, yesterday - timedelta(days=1), yesterday + timedelta(days=1)]
    bronze = bronze_of(spark, [quiz("c", passed=True, user=str(day), day=day) for day in days])
    assert tuples(ct.completed_users(bronze, "c")) == [(str(yesterday),)]
    assert [r.users for r in ct.course_completion(bronze, "c").collect()] == [1, 1]


def test_missing_types(spark, all_types):
    assert tuples(ct.missing_event_types(all_types)) == []
    some = all_types.where("event_type NOT IN ('video_started', 'article_viewed')")
    assert tuples(ct.missing_event_types(some)) == [("article_viewed",), ("video_started",)]
    assert len(tuples(ct.missing_event_types(bronze_of(spark, [bronze_row(None), bronze_row("other")])))) == 6


def test_health(spark, all_types):
    silver = ct.user_progress(all_types, DAY)
    assert tuples(ct.pipeline_health(all_types, silver)) == [(6, 1, 6, True, 1, 1, "HEALTHY")]
    assert tuples(ct.pipeline_health(all_types, silver.limit(0))) == [(6, 0, 6, True, 1, 1, "NEEDS_ATTENTION")]
    nothing = bronze_of(spark, [])
    assert tuples(ct.pipeline_health(nothing, silver)) == [(0, 1, 0, False, 0, 0, "NEEDS_ATTENTION")]


def test_health_counts_null_as_a_value(spark, all_types):
    strays = bronze_of(spark, [bronze_row(None, user=None, course=None, day=None)] * 2)
    counts = tuples(ct.pipeline_health(all_types.union(strays), ct.user_progress(all_types, DAY)))
    assert counts == [(8, 1, 7, False, 2, 2, "NEEDS_ATTENTION")]


def test_distinct_with_null(spark):
    frame = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "x string")
    expected = frame.distinct().count()
    assert frame.agg(distinct_with_null("x").alias("n")).first().n == expected == 3
    assert frame.limit(0).agg(distinct_with_null("x").alias("n")).first().n == 0


def test_freshness(spark, all_types):
    silver = ct.user_progress(all_types, DAY)
    [row] = ct.freshness(all_types, silver).collect()
    assert row.latest_event == f"{DAY}T10:00:00+00:00" and row.latest_silver_run is not None
    assert tuples(ct.freshness(bronze_of(spark, []), silver.limit(0))) == [(None, None)]


def test_profile(spark, all_types):
    profile = tuples(ct.table_profile(ct.user_progress(all_types, DAY)))
    assert [(name, kind) for _, name, kind, _ in profile] == [
        (f.name, f.dataType.simpleString()) for f in SILVER
    ]
    assert [place for place, *_ in profile] == list(range(1, 20))
    assert {records for *_, records in profile} == {1}
