"""Profiles of columns over any range of days from sketches kept by day.

A day has a distinct sketch (HyperLogLog) and, for numbers, a quantile sketch (KLL) of every profiled column, some
kilobytes each, made in one pass and merged before the shuffle. Sketches of days add up, so a range is profiled
without its rows. Counts, nulls, least and greatest value are exact.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import SKETCHES
from ..session import as_day

#: Columns by the name they are profiled under, and whether they are numbers.
PROFILED = {
    "event_type": ("event_type", False),
    "user_id": ("user_id", False),
    "course_id": ("course_id", False),
    "video_id": ("payload.video_id", False),
    "score": ("payload.score", True),
    "watch_seconds": ("payload.watch_seconds", True),
    "timestamp_ms": ("timestamp_ms", True),
}
#: Sizes of the sketches and the errors they promise, with 99 % confidence: of a count of distinct values relative to it
#: (three times 1.04 / sqrt(2 ** LG_K)), of a quantile's rank as a share of the values.
LG_K, DISTINCT_ERROR = 12, 0.05
KLL_K, RANK_ERROR = 400, 0.01
QUANTILES = {"p05": 0.05, "median": 0.5, "p95": 0.95}


def day_sketches(table: DataFrame, columns: Mapping[str, tuple[str, bool]] = PROFILED) -> DataFrame:
    """A row per day and column; rows without a day make a day of their own."""

    def sketched(name: str, source: str, number: bool) -> Column:
        value = F.col(source)
        as_number = value.cast("double") if number else F.lit(None).cast("double")
        return F.struct(
            F.lit(name).alias("column_name"),
            F.count(F.lit(1)).alias("records"),
            F.count_if(value.isNull()).alias("nulls"),
            F.min(as_number).alias("least"),
            F.max(as_number).alias("greatest"),
            F.hll_sketch_agg(value.cast("string"), LG_K).alias("distinct"),
            F.kll_sketch_agg_double(as_number, KLL_K).alias("quantiles"),
        )

    each = [sketched(name, source, number) for name, (source, number) in columns.items()]
    made = table.groupBy("event_date").agg(F.array(*each).alias("each"))
    return made.select("event_date", F.inline("each")).select(*SKETCHES.names)


def merge_sketches(
    sketches: DataFrame, start: date | str | None = None, end: date | str | None = None
) -> DataFrame:
    """One row per column for the days of a range, both ends included; all days without ends."""
    if start is not None:
        sketches = sketches.where(F.col("event_date") >= F.lit(as_day(start)))
    if end is not None:
        sketches = sketches.where(F.col("event_date") <= F.lit(as_day(end)))
    return sketches.groupBy("column_name").agg(
        F.sum("records").alias("records"),
        F.sum("nulls").alias("nulls"),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )


def profile_of(merged: DataFrame) -> DataFrame:
    """Counts, an estimate of the distinct values (null is none) and estimated quantiles, null for columns without numbers."""
    numbers = F.col("least").isNotNull()
    quantiles = [F.when(numbers, F.kll_sketch_get_quantile_double("quantiles", F.lit(q))).alias(name) for name, q in QUANTILES.items()]
    return merged.select(
        "column_name",
        "records",
        "nulls",
        F.hll_sketch_estimate("distinct").alias("distinct_values"),
        "least",
        *quantiles,
        "greatest",
    )
