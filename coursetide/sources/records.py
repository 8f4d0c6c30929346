"""Streams of raw event records: the Kafka topic, or files holding its records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import KAFKA_RECORD

# Most records of one trigger unless given: some six seconds of parsing on eight cores.
RECORDS_PER_TRIGGER = 2_000_000


def kafka_options(
    servers: str,
    topic: str = "lms_events",
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int = RECORDS_PER_TRIGGER,
    min_partitions: int | None = None,
    more: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of the Kafka source; ``more`` holds any others, such as ``kafka.security.protocol``.

    ``min_partitions`` reads with at least so many tasks and so splits a topic partition
    that holds most of the records; give about the number of cores.
    """
    for name, value in (("max_offsets_per_trigger", max_offsets_per_trigger), ("min_partitions", min_partitions)):
        if value is not None and value < 1:
            raise ValueError(f"{name} is {value}, and must be at least 1")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "maxOffsetsPerTrigger": str(max_offsets_per_trigger),
    }
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options | dict(more or {})


def kafka_records(spark: SparkSession, servers: str, **options) -> DataFrame:
    """Stream of one topic's records. Needs Spark's Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, **options)).load()


def replay_records(
    spark: SparkSession,
    path: str,
    files_per_trigger: int | None = None,
    starting_offsets: Mapping[int, int] | None = None,
    ending_offsets: Mapping[int, int] | None = None,
) -> DataFrame:
    """Stream of Parquet files that hold records in the Kafka source's schema.

    Offsets by log partition, as the Kafka source takes them: the first one that is read, and the first one that is not;
    partitions that are not named are read whole. Both are pushed down to the scan. Check what was read
    with :func:`coursetide.require_no_gaps`, for ``failOnDataLoss``.
    """
    reader = spark.readStream.schema(KAFKA_RECORD)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    records = reader.parquet(path)
    for part, first in (starting_offsets or {}).items():
        records = records.where((F.col("partition") != part) | (F.col("offset") >= first))
    for part, end in (ending_offsets or {}).items():
        records = records.where((F.col("partition") != part) | (F.col("offset") < end))
    return records
