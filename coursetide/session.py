"""Session support: the UTC zone, day arguments and scratch folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_ZONE = "spark.sql.session.timeZone"
_UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Z", "+00:00"}


_FIRST_WIDTH = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def prepare(spark: SparkSession) -> SparkSession:
    """Set the session zone to UTC, on which every calendar day in this package rests.

    Adaptive execution merges shuffle partitions but does not cut those of an aggregate, so
    shuffles begin with many, unless the session says how many. Nothing else is changed.
    """
    spark.conf.set(_ZONE, "UTC")
    if spark.conf.get(_FIRST_WIDTH, None) is None:
        spark.conf.set(_FIRST_WIDTH, "2000")
    return spark


def require_utc(df: DataFrame) -> None:
    zone = df.sparkSession.conf.get(_ZONE)
    if zone not in _UTC_NAMES:
        raise ValueError(f"session zone is {zone}, not UTC: call coursetide.prepare(spark) first")


def as_day(day: date | str) -> date:
    """The UTC day; a time without a zone is taken as UTC."""
    if isinstance(day, datetime):
        return (day.astimezone(timezone.utc) if day.tzinfo else day).date()
    return day if isinstance(day, date) else date.fromisoformat(day)


def yesterday_utc() -> date:
    return datetime.now(timezone.utc).date() - timedelta(days=1)


def few_rows(spark: SparkSession, rows: Iterable[tuple], schema: StructType) -> DataFrame:
    """A small table of literals, made by the JVM alone."""
    typed = [F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema, strict=True))) for row in rows]
    if not typed:
        return spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema))
    return spark.range(1).select(F.inline(F.array(*typed)))


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared folder the session names in ``spark.checkpoint.dir``,
    or else under the context's checkpoint folder.

    A machine-local folder is made only where both are absent and Spark itself runs on this
    machine in one process.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if shared is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="coursetide-")
    return f"{shared.rstrip('/')}/coursetide/{purpose}-{uuid.uuid4().hex}"
