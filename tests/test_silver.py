from __future__ import annotations

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import coursetide as ct
from coursetide.schemas import COUNTERS, EVENT_TYPES, SILVER

from .rows import DAY, bronze_of, bronze_row


def progress(spark, *rows):
    [row] = ct.user_progress(bronze_of(spark, rows), DAY).collect()
    return row


def test_columns_and_types(spark):
    silver = ct.user_progress(bronze_of(spark, []), DAY)
    assert [(f.name, f.dataType) for f in silver.schema] == [(f.name, f.dataType) for f in SILVER]


def test_article_alone(spark):
    row = progress(spark, bronze_row("article_viewed"))
    assert row.articles_viewed == 1 and row.total_watch_seconds == 0
    assert row.video_completion_rate_percent is None and row.quiz_completion_rate_percent is None
    assert row.completion_score is None and row.avg_quiz_score is None
    assert (row.engagement_level, row.is_active_learner) == ("Low", True)
    assert row.processing_timestamp.date() == row.processing_date


def test_completed_video_without_watch_time(spark):
    row = progress(spark, bronze_row("video_completed"))
    assert row.total_watch_seconds is None and row.video_completion_rate_percent == 100.0


def test_rate_is_over_opened_and_finished(spark):
    row = progress(spark, bronze_row("video_started"), bronze_row("video_completed", watch_seconds=90))
    assert row.video_completion_rate_percent == 50.0
    assert (row.total_watch_seconds, row.engagement_level) == (90, "Medium")


def test_watch_time_counts_for_completed_videos_only(spark):
    row = progress(
        spark,
        bronze_row("video_started", watch_seconds=1000),
        bronze_row("video_completed", watch_seconds=30),
        bronze_row("video_completed"),
    )
    assert row.total_watch_seconds == 30


def test_both_rates_give_the_score(spark):
    row = progress(
        spark,
        bronze_row("video_completed", watch_seconds=5),
        bronze_row("quiz_attempted"),
        bronze_row("quiz_submitted", score=70.0),
        bronze_row("quiz_submitted", score=80.0),
        bronze_row("quiz_submitted"),
    )
    assert row.avg_quiz_score == 75.0
    assert row.quiz_completion_rate_percent == 75.0
    assert row.completion_score == 87.5
    assert row.engagement_level == "High"


def test_null_course_is_not_counted(spark):
    courses = ["a", "b", "b", "c", None]
    row = progress(spark, *(bronze_row("article_viewed", course=c) for c in courses))
    assert row.unique_courses_accessed == 3 and row.engagement_level == "High"


def test_null_type_counts_as_activity_only(spark):
    row = progress(spark, bronze_row(None))
    assert row.total_activities == 1 and all(row[name] == 0 for name in COUNTERS)


def test_null_user_is_a_group(spark):
    row = progress(spark, bronze_row("article_viewed", user=None), bronze_row("article_viewed", user=None))
    assert row.user_id is None and row.total_activities == 2


def test_other_days_and_no_day_are_left_out(spark):
    bronze = bronze_of(
        spark,
        [
            bronze_row("article_viewed"),
            bronze_row("article_viewed", day=date(2025, 1, 3)),
            bronze_row("article_viewed", day=None),
        ],
    )
    assert [r.event_date for r in ct.user_progress(bronze, "2025-01-02").collect()] == [DAY]
    days = ct.user_progress_between(bronze).collect()
    assert sorted(r.event_date for r in days) == [DAY, date(2025, 1, 3)]
    later = ct.user_progress_between(bronze, start="2025-01-03", end="2025-01-09").collect()
    assert [r.event_date for r in later] == [date(2025, 1, 3)]


events = st.tuples(
    st.sampled_from([*EVENT_TYPES, None]),
    st.sampled_from(["u1", "u2", "u3", None]),
    st.sampled_from(["c1", "c2", None]),
    st.one_of(st.none(), st.integers(0, 1800)),
    st.one_of(st.none(), st.integers(0, 100)),
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(events, min_size=1, max_size=40))
def test_invariants(spark, drawn):
    bronze = bronze_of(
        spark,
        [
            bronze_row(kind, user, course, watch_seconds=watch, score=None if score is None else float(score))
            for kind, user, course, watch, score in drawn
        ],
    )
    rows = ct.user_progress(bronze, DAY).collect()
    assert sum(r.total_activities for r in rows) == len(drawn)
    assert {r.user_id for r in rows} == {user for _, user, *_ in drawn}
    for r in rows:
        mine = [d for d in drawn if d[1] == r.user_id]
        assert sum(r[name] for name in COUNTERS) == sum(1 for d in mine if d[0] is not None)
        assert r.unique_courses_accessed == len({d[2] for d in mine} - {None})
        scores = [d[4] for d in mine if d[0] == "quiz_submitted" and d[4] is not None]
        assert r.avg_quiz_score == (pytest.approx(sum(scores) / len(scores)) if scores else None)
        for rate in (r.video_completion_rate_percent, r.quiz_completion_rate_percent, r.completion_score):
            assert rate is None or 0 <= rate <= 100
        level = "High" if len(mine) >= 5 else "Medium" if len(mine) >= 2 else "Low"
        assert r.engagement_level == level


def test_levels_and_shares(spark):
    users = [("a", 5), ("b", 2), ("c", 1)]
    bronze = bronze_of(spark, [bronze_row("article_viewed", user=u) for u, n in users for _ in range(n)])
    shares = ct.engagement_distribution(ct.user_progress(bronze, DAY)).collect()
    assert [tuple(r) for r in shares] == [("High", 1, 33.3), ("Low", 1, 33.3), ("Medium", 1, 33.3)]
