"""KPIs of any range of days from one small table of states, in place of the events.

A state is what can be added up: rows, rows with a value, and the sum of the values, for a day, a measure and a key.
Averages are taken and rankings sorted only after adding. Of bronze the measures are the event types, keyed by
what their KPI ranks (courses or videos); of silver they are the engagement level and the averaged
columns, keyed by the level. Replacing the states of a day replaces what that day adds.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import percent_of
from ..schemas import EVENT_TYPES, STATES
from ..session import as_day

#: What each KPI over silver averages.
AVERAGED = {
    "avg_quiz_completion_%": "quiz_completion_rate_percent",
    "avg_video_completion_%": "video_completion_rate_percent",
    "avg_completion_score": "completion_score",
}
LEVEL = "engagement_level"


def bronze_states(bronze: DataFrame) -> DataFrame:
    """States of events: one shuffle, of as many rows a task as it has days, types and keys."""
    kind = F.col("event_type")
    key = F.when(kind.isin("course_enrolled", "quiz_submitted"), F.col("course_id")).when(
        kind == "video_completed", F.col("payload.video_id")
    )
    score = F.when(kind == "quiz_submitted", F.col("payload.score"))
    watched = F.when(kind == "video_completed", F.col("payload.watch_seconds"))
    facts = bronze.select(
        "event_date", kind.alias("measure"), key.alias("key"), score.alias("score"), watched.alias("watched")
    )
    return facts.groupBy("event_date", "measure", "key").agg(
        F.count(F.lit(1)).alias("records"),
        (F.count("score") + F.count("watched")).alias("valued"),
        F.sum("score").alias("total"),
        F.sum("watched").alias("whole"),
    ).select(F.lit("bronze").alias("source"), *STATES.names[1:])


def silver_states(silver: DataFrame) -> DataFrame:
    """States of learners' days: one shuffle, of at most three rows for a task and day."""
    sums = [e for column in AVERAGED.values() for e in (F.count(column).alias(f"n_{column}"), F.sum(column).alias(column))]
    levels = silver.groupBy("event_date", LEVEL).agg(F.count(F.lit(1)).alias("records"), *sums)
    nothing = F.lit(None).cast("double")

    def state(measure: str, valued: F.Column, total: F.Column) -> F.Column:
        return F.struct(F.lit(measure).alias("measure"), valued.alias("valued"), total.alias("total"))

    each = [state(LEVEL, F.lit(0).cast("long"), nothing)]
    each += [state(column, F.col(f"n_{column}"), F.col(column)) for column in AVERAGED.values()]
    exploded = levels.select("event_date", F.col(LEVEL).alias("key"), "records", F.explode(F.array(*each)).alias("s"))
    return exploded.select(
        F.lit("silver").alias("source"),
        "event_date",
        "s.measure",
        "key",
        "records",
        "s.valued",
        "s.total",
        F.lit(None).cast("long").alias("whole"),
    )


def day_states(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    return bronze_states(bronze).unionByName(silver_states(silver))


def merge_states(
    states: DataFrame, start: date | str | None = None, end: date | str | None = None
) -> DataFrame:
    """The states of all days of a range, both ends included, as one; all days without ends, rows without a day among them."""
    if start is not None:
        states = states.where(F.col("event_date") >= F.lit(as_day(start)))
    if end is not None:
        states = states.where(F.col("event_date") <= F.lit(as_day(end)))
    return states.groupBy("source", "measure", "key").agg(
        F.sum("records").alias("records"),
        F.sum("valued").alias("valued"),
        F.sum("total").alias("total"),
        F.sum("whole").alias("whole"),
    )


def silver_kpis_of(merged: DataFrame) -> DataFrame:
    """As :func:`coursetide.silver_kpis`; the following are named alike."""

    def average(column: str) -> F.Column:
        mine = F.col("measure") == column
        total, valued = (F.sum(F.when(mine, F.col(name))) for name in ("total", "valued"))
        return F.round(F.try_divide(total, valued), 1)

    return merged.where("source = 'silver'").agg(*(average(column).alias(name) for name, column in AVERAGED.items()))


def engagement_distribution_of(merged: DataFrame) -> DataFrame:
    levels = merged.where((F.col("source") == "silver") & (F.col("measure") == LEVEL))
    levels = levels.groupBy(F.col("key").alias(LEVEL)).agg(F.sum("records").alias("count"))
    total = F.sum("count").over(Window.partitionBy())  # over the levels, of which there are few
    return levels.withColumn("percentage", percent_of(F.col("count"), total, 1)).orderBy(F.desc("count"), LEVEL)


def events_by_type_of(merged: DataFrame) -> DataFrame:
    types = merged.where("source = 'bronze'").groupBy(F.col("measure").alias("event_type"))
    return types.agg(F.sum("records").alias("count")).orderBy("event_type")


def top_courses_of(merged: DataFrame, k: int = 10) -> DataFrame:
    return _ranked(merged, "course_enrolled", "course_id", F.col("records").alias("count"), k)


def avg_quiz_score_per_course_of(merged: DataFrame) -> DataFrame:
    score = F.round(F.try_divide("total", "valued"), 2).alias("avg_quiz_score")
    return _ranked(merged, "quiz_submitted", "course_id", score)


def most_watched_videos_of(merged: DataFrame, k: int | None = None) -> DataFrame:
    return _ranked(merged, "video_completed", "video_id", F.col("whole").alias("total_watch_seconds"), k)


def _ranked(merged: DataFrame, measure: str, key: str, value: F.Column, k: int | None = None) -> DataFrame:
    own = merged.where((F.col("source") == "bronze") & (F.col("measure") == measure))
    ranked = own.select(F.col("key").alias(key), value)
    ranked = ranked.orderBy(F.desc_nulls_last(ranked.columns[1]), key)
    return ranked if k is None else ranked.limit(k)


def pipeline_health_of(merged: DataFrame, distinct: DataFrame) -> DataFrame:
    """As :func:`coursetide.pipeline_health`, from merged states and the distinct counts of the same days."""

    def records(source: str, only: F.Column) -> F.Column:
        mine = (F.col("source") == source) & only
        return F.coalesce(F.sum(F.when(mine, F.col("records"))), F.lit(0)).alias(f"{source}_records")

    def values(column: str, name: str) -> F.Column:
        return F.coalesce(F.max(F.when(F.col("column_name") == column, F.col("distinct_values"))), F.lit(0)).alias(name)

    rows = merged.agg(records("bronze", F.lit(True)), records("silver", F.col("measure") == LEVEL))
    counts = distinct.agg(
        values("event_type", "event_types"), values("user_id", "active_users"), values("course_id", "active_courses")
    )
    # two tables of one row each
    both = merged.sparkSession.range(1).select(
        *(rows.select(name).scalar().alias(name) for name in rows.columns),
        *(counts.select(name).scalar().alias(name) for name in counts.columns),
    )
    types_ok = F.col("event_types") == len(EVENT_TYPES)
    healthy = types_ok
    for name in ("bronze_records", "silver_records", "active_users", "active_courses"):
        healthy = healthy & (F.col(name) > 0)
    return both.select(
        "bronze_records",
        "silver_records",
        "event_types",
        types_ok.alias("event_types_ok"),
        "active_users",
        "active_courses",
        F.when(healthy, "HEALTHY").otherwise("NEEDS_ATTENTION").alias("status"),
    )
