"""The daily bronze-to-silver job and its repetition over past days."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import user_progress, user_progress_between
from ..session import as_day, yesterday_utc
from ..sources import observed, publish_between, publish_day_if, read_bronze, require_partition


def run_day(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    run_date: date | str | None = None,
    fmt: str = "parquet",
    files: int | None = None,
    rows_per_file: int | None = None,
    file_bytes: int | None = None,
) -> None:
    """Publish one day, yesterday unless given.

    Fails when bronze has no rows for the day, and leaves the day's silver as it was, and when silver has none
    of it. Both counts are taken by the job that publishes; no table is read for them. (With Delta, which replaces
    at commit, bronze is asked first.)
    """
    day = yesterday_utc() if run_date is None else as_day(run_date)
    bronze = read_bronze(spark, bronze_path, fmt)
    if fmt == "delta":
        require_partition(bronze, day)
    read = Observation()
    events = bronze.where(F.col("event_date") == F.lit(day)).observe(read, F.count(F.lit(1)).alias("rows"))

    def gate(written: int) -> None:
        if not observed(read, "rows"):
            raise LookupError(f"no rows for event_date={day}")
        if not written:
            raise LookupError(f"no silver rows for event_date={day}")

    publish_day_if(user_progress(events, day), silver_path, day, gate, fmt, files, rows_per_file, file_bytes)


def backfill(
    bronze: DataFrame,
    silver_path: str,
    start: date | str,
    end: date | str,
    fmt: str = "parquet",
    files: int | None = None,
    days_per_job: int | None = None,
    rows_per_file: int | None = None,
    file_bytes: int | None = None,
) -> None:
    """Publish every day from ``start`` to ``end``; days without events come out empty.

    The whole range is one job unless ``days_per_job`` cuts it, which bounds the shuffle
    of each job and what a failed one has to repeat.
    """
    first, last = as_day(start), as_day(end)
    if first > last:
        raise ValueError(f"the range begins on {first}, after its end on {last}")
    if days_per_job is not None and days_per_job < 1:
        raise ValueError(f"days_per_job is {days_per_job}, and must be at least 1")
    step = timedelta(days=days_per_job or (last - first).days + 1)
    while first <= last:
        until = min(first + step - timedelta(days=1), last)
        silver = user_progress_between(bronze, first, until)
        publish_between(silver, silver_path, first, until, fmt, files, rows_per_file, file_bytes)
        first = until + timedelta(days=1)
