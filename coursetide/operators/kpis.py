"""Business questions over bronze and silver. Rankings break ties by their key."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import percent_of
from ..session import as_day, require_utc


def silver_kpis(silver: DataFrame) -> DataFrame:
    """One row of averages over all silver rows; null rates and scores are skipped."""
    averages = {
        "avg_quiz_completion_%": "quiz_completion_rate_percent",
        "avg_video_completion_%": "video_completion_rate_percent",
        "avg_completion_score": "completion_score",
    }
    return silver.agg(*(F.round(F.avg(column), 1).alias(name) for name, column in averages.items()))


def top_courses(bronze: DataFrame, k: int = 10) -> DataFrame:
    """The k courses with most enrolments."""
    return _ranking(bronze, "course_enrolled", "course_id", F.count("*").alias("count"), k)


def engagement_distribution(silver: DataFrame) -> DataFrame:
    """Rows and share of all rows for each engagement level.

    The total is taken over the grouped rows, one per level, so silver is read once.
    """
    levels = silver.groupBy("engagement_level").count()
    total = F.sum("count").over(Window.partitionBy())
    return levels.withColumn("percentage", percent_of(F.col("count"), total, 1)).orderBy(
        F.desc("count"), "engagement_level"
    )


def events_by_type(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("event_type").count().orderBy("event_type")


def avg_quiz_score_per_course(bronze: DataFrame) -> DataFrame:
    """Average score of submitted quizzes, best course first, courses without scores last."""
    score = F.round(F.avg("payload.score"), 2).alias("avg_quiz_score")
    return _ranking(bronze, "quiz_submitted", "course_id", score)


def most_watched_videos(bronze: DataFrame, k: int | None = None) -> DataFrame:
    """Videos by total watch time of completed views: all of them, or the k first."""
    watched = F.sum("payload.watch_seconds").alias("total_watch_seconds")
    return _ranking(bronze, "video_completed", F.col("payload.video_id").alias("video_id"), watched, k)


def completed_users(
    bronze: DataFrame,
    course_id: str,
    day: date | str | None = None,
    strict: bool = True,
    written_day: bool = False,
) -> DataFrame:
    """Learners who submitted a quiz of the course on the day, passed if ``strict``.

    The day defaults to yesterday. It is the stored UTC day, or with ``written_day`` the date
    that stands in the event's time text, whatever its zone.
    """
    submitted = _submissions(bronze, course_id, day, written_day)
    if strict:
        submitted = submitted.where(F.col("passed") == F.lit(True))
    return submitted.select("user_id").distinct()


def course_completion(
    bronze: DataFrame, course_id: str, day: date | str | None = None, written_day: bool = False
) -> DataFrame:
    """Both user counts of :func:`completed_users` as two rows, from one pass.

    Grouping by learner first makes a missing user id count as one user, as a distinct
    list has it, and leaves two plain counts over the groups.
    """
    learners = (
        _submissions(bronze, course_id, day, written_day)
        .groupBy("user_id")
        .agg(F.coalesce(F.bool_or("passed"), F.lit(False)).alias("passed"))
    )
    counts = learners.agg(
        F.count_if("passed").alias("strict_passed"),
        F.count(F.lit(1)).alias("loose_any_quiz"),
    )
    definitions = ["strict_passed", "loose_any_quiz"]
    return counts.unpivot([], definitions, "definition", "users").select(
        "definition", F.lit(course_id).alias("course_id"), "users"
    )


def _ranking(
    bronze: DataFrame, kind: str, key: str | Column, measure: Column, k: int | None = None
) -> DataFrame:
    """Keys of events of one type by a measure, largest first and null last, ties by key."""
    ranked = bronze.where(F.col("event_type") == kind).groupBy(key).agg(measure)
    name, value = ranked.columns
    ranked = ranked.orderBy(F.desc_nulls_last(value), name)
    return ranked if k is None else ranked.limit(k)


def _submissions(
    bronze: DataFrame, course_id: str, day: date | str | None, written_day: bool
) -> DataFrame:
    require_utc(bronze)
    wanted = _day_or_yesterday(day)
    # The stored day is the partition column: filtering on it reads one partition, or three
    # where the text's zone can shift it by a day.
    on_day = F.col("event_date") == wanted
    if written_day:
        written = F.col("timestamp_iso").substr(1, 10).try_cast("date")
        near = F.col("event_date").between(F.date_sub(wanted, 1), F.date_add(wanted, 1))
        on_day = near & (written == wanted)
    return (
        bronze.where((F.col("event_type") == "quiz_submitted") & (F.col("course_id") == course_id))
        .where(on_day)
        .select("user_id", F.col("payload.passed").alias("passed"))
    )


def _day_or_yesterday(day: date | str | None) -> Column:
    return F.date_sub(F.current_date(), 1) if day is None else F.lit(as_day(day))
