"""Bronze rows to one progress row for each learner and day."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import average_for, completion_percent, engagement_level, event_count, mean_of, total_for
from ..schemas import COUNTERS, SILVER
from ..session import as_day, require_utc


def user_progress(bronze: DataFrame, run_date: date | str) -> DataFrame:
    """Silver rows of one day."""
    day = F.lit(as_day(run_date))
    return _progress(bronze.where(F.col("event_date") == day))


def user_progress_on(bronze: DataFrame, days: Iterable[date | str]) -> DataFrame:
    """Silver rows of the given days, in one job."""
    return _progress(bronze.where(F.col("event_date").isin([as_day(day) for day in days])))


def user_progress_between(
    bronze: DataFrame, start: date | str | None = None, end: date | str | None = None
) -> DataFrame:
    """Silver rows of every day from ``start`` to ``end``, both included, in one job.

    A bound left out is open. Rows without a day belong to none and are left out.
    """
    days = bronze.where(F.col("event_date").isNotNull())
    if start is not None:
        days = days.where(F.col("event_date") >= F.lit(as_day(start)))
    if end is not None:
        days = days.where(F.col("event_date") <= F.lit(as_day(end)))
    return _progress(days)


def _progress(bronze: DataFrame) -> DataFrame:
    require_utc(bronze)
    # The exact distinct count makes Spark group by (user, day, course) first and then by
    # (user, day). Both steps combine before their shuffle, so a learner with a large
    # share of all rows sends at most one row per task and course.
    facts = bronze.select(
        "user_id",
        "event_date",
        "event_type",
        "course_id",
        F.col("payload.score").alias("score"),
        F.col("payload.watch_seconds").alias("watch_seconds"),
    )
    totals = facts.groupBy("user_id", "event_date").agg(
        *(event_count(kind).alias(name) for name, kind in COUNTERS.items()),
        F.count_distinct("course_id").alias("unique_courses_accessed"),
        F.count(F.lit(1)).alias("total_activities"),
        average_for("quiz_submitted", "score").alias("avg_quiz_score"),
        total_for("video_completed", "watch_seconds").alias("total_watch_seconds"),
    )
    rates = totals.withColumns(
        {
            "video_completion_rate_percent": completion_percent(
                F.col("videos_completed"), F.col("videos_started")
            ),
            "quiz_completion_rate_percent": completion_percent(
                F.col("quizzes_submitted"), F.col("quizzes_attempted")
            ),
            "engagement_level": engagement_level(F.col("total_activities")),
            "is_active_learner": F.col("total_activities") >= 1,
        }
    )
    return rates.withColumns(
        {
            "completion_score": mean_of(
                F.col("video_completion_rate_percent"), F.col("quiz_completion_rate_percent")
            ),
            "processing_timestamp": F.current_timestamp(),
            "processing_date": F.current_date(),
        }
    ).select(*SILVER.names)
