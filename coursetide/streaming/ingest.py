"""The streaming job from raw records to the bronze table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import parse_events

#: Name of the counts in a query's progress.
INGESTED = "ingested"


def ingest(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    every: str = "30 seconds",
    catch_up: bool = False,
    gather_days: bool = False,
    left_over: bool = False,
    added: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Append parsed records to the bronze table, partitioned by day.

    Runs a micro-batch ``every`` interval, or with ``catch_up`` works off what is there
    and stops. The checkpoint makes each record arrive once, also over restarts. Late
    records go to their own day.

    The job is map-only and leaves a file for every task and day in it. With ``gather_days``,
    meant for catching up over many days, each batch is shuffled by day first, adaptive
    execution cutting a large day into several tasks, so that it leaves few large files.

    What each batch took up is counted on its way, see :func:`ingested`.

    ``left_over`` and ``added`` are those of :func:`coursetide.parse_events`. Both may be taken up, and fields added,
    when the stream is started again from its checkpoint: rows from before read as null there.
    """
    events = parse_events(raw, left_over, added).observe(
        INGESTED,
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("event_date").isNull()).alias("without_day"),
        F.max("timestamp_iso").alias("latest_event"),
    )
    if gather_days:
        events = events.hint("rebalance", "event_date")
    writer = (
        events.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy("event_date")
        .trigger(**({"availableNow": True} if catch_up else {"processingTime": every}))
    )
    if fmt == "delta":
        writer = writer.option("mergeSchema", True)
    return writer.start(path)


def ingested(query: StreamingQuery) -> dict[str, int | str | None]:
    """Records, records without a day, and the latest event time text of the batches that Spark still remembers of a
    query (the last hundred unless set otherwise): counts for gates and for freshness that read no table."""
    batches = [progress.observedMetrics[INGESTED] for progress in query.recentProgress if INGESTED in progress.observedMetrics]
    latest = [row["latest_event"] for row in batches if row["latest_event"] is not None]
    return {
        "records": sum(row["records"] for row in batches),
        "without_day": sum(row["without_day"] for row in batches),
        "latest_event": max(latest, default=None),
    }
