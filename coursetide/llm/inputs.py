"""Small helpers that several operators share."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coursetide.session import scratch_dir


def findable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, if that is a folder they see;
    elsewhere it is installed or sent along as any package is."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*known, root]))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    findable(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def in_fold(doc_id: str, parts: int, held_out: int) -> Column:
    """Whether crc32 of the id as text falls on the held-out remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == held_out, F.lit(False))


def few_at_once(
    batches: Iterator[pa.RecordBatch], column: str | int, size: int = 1 << 20
) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``size`` bytes of ``column``, a longer value by itself: Spark counts rows
    into a batch, and what a worker makes of them should not take memory by the batch."""
    for batch in batches:
        held = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        first = 0
        while first < batch.num_rows:
            before = held[first - 1] if first else 0
            end = max(first + 1, int(np.searchsorted(held, before + size, side="right")))
            yield batch.slice(first, end - first)
            first = end


def one_text_each(drawn: DataFrame) -> DataFrame:
    """One row of ``doc_id``, ``label`` and ``text`` per id, of several texts the one of the least hash."""
    least = F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text")
    return drawn.groupBy("doc_id", "label").agg(least)


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows, written to the shared checkpoint folder and read back.

    A table and not an RDD checkpoint: columns are compressed and statistics are known.
    """
    path = scratch_dir(df.sparkSession, "llm")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
