"""Aggregate column expressions over bronze rows. All combine map-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_count(kind: str) -> Column:
    """Rows of one event type; rows with a null type count for none."""
    return F.count_if(F.col("event_type") == kind)


def average_for(kind: str, value: str) -> Column:
    """Average over the rows of one event type, null when there are none."""
    return F.avg(F.when(F.col("event_type") == kind, F.col(value)))


def total_for(kind: str, value: str) -> Column:
    """Sum over the rows of one event type; rows of other types add 0, so that only
    groups made up of matching rows with null values give null."""
    return F.sum(F.when(F.col("event_type") == kind, F.col(value)).otherwise(F.lit(0)))


def distinct_with_null(column: str) -> Column:
    """Distinct values with null as one value, as ``distinct().count()`` gives."""
    value = F.col(column)
    return F.count_distinct(value) + F.coalesce(F.max(value.isNull().cast("int")), F.lit(0))
