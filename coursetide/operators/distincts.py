"""Exact distinct counts over any range of days, from bitmaps kept by day.

A value's bit is its number (see ``sources.numbers``), null being number 0. A day's bitmaps take a shuffle of its
distinct values once; after that a range is counted by or-ing bitmaps of 32,768 values each, and no value is
shuffled again. Days and tables add up exactly, unlike counts.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import BITMAPS
from ..session import as_day

#: Columns whose values the health check counts.
COUNTED = ("event_type", "user_id", "course_id")


def day_bitmaps(bronze: DataFrame, numbers: DataFrame, columns: Iterable[str] = COUNTED) -> DataFrame:
    """Bitmaps of each day and column; rows without a day make a day of their own.

    A value that has no number is an error, raised when rows are computed: it would not be counted.
    """
    return reduce(DataFrame.unionByName, (_bitmaps(bronze, numbers, column) for column in columns)).select(*BITMAPS.names)


def _bitmaps(bronze: DataFrame, numbers: DataFrame, column: str) -> DataFrame:
    values = bronze.select("event_date", F.col(column).cast("string").alias("value")).distinct()
    own = numbers.where(F.col("column_name") == column).select("value", "number")
    joined = values.join(own.hint("merge"), "value", "left")
    without = F.raise_error(F.concat(F.lit(f"a value of {column} has no number: "), F.col("value"))).cast("long")
    number = F.when(F.col("value").isNull(), 0).otherwise(F.coalesce("number", without))
    placed = joined.select("event_date", number.alias("number"))
    bucket = F.bitmap_bucket_number("number").alias("bucket")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
    return placed.groupBy("event_date", bucket).agg(bits).withColumn("column_name", F.lit(column))


def distinct_counts(
    bitmaps: DataFrame, start: date | str | None = None, end: date | str | None = None
) -> DataFrame:
    """``column_name`` and ``distinct_values`` over the days of a range, null counting as a value; all days without ends."""
    if start is not None:
        bitmaps = bitmaps.where(F.col("event_date") >= F.lit(as_day(start)))
    if end is not None:
        bitmaps = bitmaps.where(F.col("event_date") <= F.lit(as_day(end)))
    merged = bitmaps.groupBy("column_name", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy("column_name").agg(F.sum(F.bitmap_count("bits")).alias("distinct_values"))


def distinct_by_day(bitmaps: DataFrame) -> DataFrame:
    """The same for each day by itself."""
    days = bitmaps.groupBy("event_date", "column_name")
    return days.agg(F.sum(F.bitmap_count("bits")).alias("distinct_values")).orderBy("event_date", "column_name")
