"""Silver kept up with bronze: days that got new rows are computed and published again."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import user_progress_on
from ..schemas import BRONZE, FINISHED
from ..session import few_rows
from ..sources import on_days, publish_days, read_bronze

_QUERY_ID = "sql.streaming.queryId"

Refresh = Callable[[DataFrame, list[date | None]], None]


def follow_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    checkpoint: str,
    fmt: str = "parquet",
    every: str = "30 seconds",
    catch_up: bool = False,
    files_per_trigger: int | None = None,
    files: int | None = None,
    rows_per_file: int | None = None,
    file_bytes: int | None = None,
    also: Refresh | None = None,
) -> StreamingQuery:
    """Publish every day anew that a batch of new bronze rows belongs to, so that late rows reach silver.

    A batch names the days and no more: each is computed from all its bronze rows and replaced
    as a whole, so working off a batch twice, or rows arriving while it runs, gives the same table. A batch that was
    finished is known by query and batch id and passed over when it comes again after a failure.
    Rows without a day belong to no silver row; they are told to ``also`` as the day None.

    ``files_per_trigger`` bounds how much a batch takes up; the other options are those of
    :func:`coursetide.publish_days`. ``also`` is called with the bronze rows of the touched days and these days, before
    the batch counts as finished: further tables by day are kept up with it, and must stand a repetition as well.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "parquet":
        reader = reader.schema(BRONZE)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)

    def work_off(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        done, mark = f"{checkpoint.rstrip('/')}/finished", (own.sparkContext.getLocalProperty(_QUERY_ID), batch_id)
        if _last_finished(own, done) == mark:
            return
        touched = touched_days(batch)
        days = [day for day in touched if day is not None]
        bronze = read_bronze(own, bronze_path, fmt)
        if days:
            publish_days(user_progress_on(bronze, days), silver_path, days, fmt, files, rows_per_file, file_bytes)
        if touched and also is not None:
            also(bronze.where(on_days(touched)), touched)
        few_rows(own, [mark], FINISHED).coalesce(1).write.mode("overwrite").parquet(done)

    writer = reader.load(bronze_path).select("event_date").writeStream.foreachBatch(work_off)
    trigger = {"availableNow": True} if catch_up else {"processingTime": every}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def touched_days(rows: DataFrame) -> list[date | None]:
    """The days that rows belong to, in order, None for those without one; reads the partition column only."""
    days = [r.event_date for r in rows.select("event_date").distinct().collect()]
    return [None] * (None in days) + sorted(day for day in days if day is not None)


def _last_finished(spark: SparkSession, path: str) -> tuple[str, int] | None:
    """Batches follow each other, so the last one is enough. Where its mark was lost, work is done once more."""
    try:
        marks = spark.read.schema(FINISHED).parquet(path)
        last = marks.first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return None if last is None else (last.query_id, last.batch_id)
