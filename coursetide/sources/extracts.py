"""CSV extracts, stamped with and partitioned by the day they were taken for."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import as_day


def append_extract(
    df: DataFrame,
    path: str,
    metric_date: date | str,
    keys: Sequence[str] = (),
    files: int | None = None,
) -> None:
    """Append rows as CSV with a header under ``metric_date=.../<key>=...``.

    Repeating an extract for the same day adds its rows again. A ranking keeps its order
    through the sorted file names; ``files`` joins them into fewer files.
    """
    stamped = df.withColumn("metric_date", F.lit(as_day(metric_date)))
    if files is not None:
        stamped = stamped.coalesce(files)
    (
        stamped.write.mode("append")
        .option("header", True)
        .partitionBy("metric_date", *keys)
        .csv(path)
    )
