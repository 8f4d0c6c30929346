"""Checks of the two tables: freshness, required types, health status, profile."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import EVENT_TYPES


def freshness(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """One row: the latest event time text in bronze and the latest silver run."""
    last_run = silver.select(F.max("processing_timestamp")).scalar()
    return bronze.agg(F.max("timestamp_iso").alias("latest_event")).select(
        "latest_event", last_run.alias("latest_silver_run")
    )


def missing_event_types(bronze: DataFrame, required: Iterable[str] = EVENT_TYPES) -> DataFrame:
    """Required event types bronze has no row of, sorted.

    Only required types are gathered, so the set in the aggregate is no larger than the
    argument, whatever bronze holds.
    """
    wanted = sorted(set(required))
    seen = bronze.where(F.col("event_type").isin(wanted)).agg(
        F.collect_set("event_type").alias("types")
    )
    absent = F.array_except(F.array(*map(F.lit, wanted)), F.col("types"))
    return seen.select(F.explode(F.array_sort(absent)).alias("event_type"))


def pipeline_health(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """One row of counts and the status.

    Each distinct count is a query of its own over one column: together they would multiply
    every row by the number of counts. Rows are counted from file footers. Null counts as a type, user or course of its own, so one unreadable record turns a
    table that has exactly the expected types into one that needs attention.
    """
    counts = bronze.sparkSession.range(1).select(
        bronze.select(F.count(F.lit(1))).scalar().alias("bronze_records"),
        silver.select(F.count(F.lit(1))).scalar().alias("silver_records"),
        _distinct(bronze, "event_type").alias("event_types"),
        _distinct(bronze, "user_id").alias("active_users"),
        _distinct(bronze, "course_id").alias("active_courses"),
    ).withColumn("event_types_ok", F.col("event_types") == len(EVENT_TYPES))
    healthy = F.col("event_types_ok")
    for name in ("bronze_records", "silver_records", "active_users", "active_courses"):
        healthy = healthy & (F.col(name) > 0)
    return counts.select(
        "bronze_records",
        "silver_records",
        "event_types",
        "event_types_ok",
        "active_users",
        "active_courses",
        F.when(healthy, "HEALTHY").otherwise("NEEDS_ATTENTION").alias("status"),
    )


def _distinct(table: DataFrame, column: str) -> Column:
    """How many distinct values there are, null being one."""
    return table.select(column).distinct().select(F.count(F.lit(1))).scalar()


def offset_gaps(records: DataFrame) -> DataFrame:
    """A row per log partition: its first and last offset, records, how many offsets between are missing and how many
    records repeat an offset. Works on raw records and on bronze; records without an offset are left out.

    Offsets are or-ed to bitmaps of 32,768 before the shuffle, so a partition that holds most records is combined in
    all tasks, and no offset is shuffled by itself.
    """
    bits = (
        records.where("offset is not null")
        .groupBy("partition", F.bitmap_bucket_number("offset").alias("bucket"))
        .agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("offset")).alias("bits"),
            F.count(F.lit(1)).alias("records"),
            F.min("offset").alias("first"),
            F.max("offset").alias("last"),
        )
    )
    met = bits.groupBy("partition").agg(
        F.min("first").alias("first_offset"),
        F.max("last").alias("last_offset"),
        F.sum("records").alias("records"),
        F.sum(F.bitmap_count("bits")).alias("offsets"),
    )
    return met.select(
        "partition",
        "first_offset",
        "last_offset",
        "records",
        (F.col("last_offset") - F.col("first_offset") + 1 - F.col("offsets")).alias("missing"),
        (F.col("records") - F.col("offsets")).alias("repeated"),
    )


def require_no_gaps(records: DataFrame) -> None:
    """Raise if an offset between the first and the last of a log partition is missing."""
    lost = offset_gaps(records).where("missing > 0").orderBy("partition").limit(10).collect()
    if lost:
        told = ", ".join(f"{r.missing} of partition {r.partition} between {r.first_offset} and {r.last_offset}" for r in lost)
        raise LookupError(f"missing offsets: {told}")


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column, with its type and the row count of the table."""
    columns = F.array(
        *(
            F.struct(
                F.lit(place).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
            )
            for place, field in enumerate(df.schema, start=1)
        )
    )
    return df.agg(F.count(F.lit(1)).alias("records")).select(F.inline(columns), "records")
