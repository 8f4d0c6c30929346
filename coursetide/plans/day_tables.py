"""States, bitmaps and value numbers kept by day, from which ranges of days are answered."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ..operators import COUNTED, day_bitmaps, day_states
from ..schemas import BITMAPS, STATES
from ..sources import grow_numbers, on_days, publish_days, read_days, read_numbers, read_silver


def refresh_day_tables(
    bronze: DataFrame, silver: DataFrame, root: str, days: Iterable[date | str | None], fmt: str = "parquet"
) -> None:
    """Replace what the given days add to KPIs and distinct counts; None stands for rows without a day.

    Values are numbered before bitmaps are made of them. Repeating it, or failing between the tables and
    beginning again, gives the same tables.
    """
    days = list(days)
    bronze, silver = bronze.where(on_days(days)), silver.where(on_days(days))
    grow_numbers(bronze, f"{root}/numbers", COUNTED)
    publish_days(day_states(bronze, silver), f"{root}/states", days, fmt)
    publish_days(day_bitmaps(bronze, read_numbers(bronze.sparkSession, f"{root}/numbers")), f"{root}/bitmaps", days, fmt)


def refresher(silver_path: str, root: str, fmt: str = "parquet") -> Callable[[DataFrame, list[date | None]], None]:
    """For ``follow_silver(also=...)``: keeps the day tables up with a published silver table."""

    def refresh(bronze: DataFrame, days: list[date | None]) -> None:
        refresh_day_tables(bronze, read_silver(bronze.sparkSession, silver_path, fmt), root, days, fmt)

    return refresh


def read_day_tables(spark: SparkSession, root: str, fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """States and bitmaps."""
    return read_days(spark, f"{root}/states", STATES, fmt), read_days(spark, f"{root}/bitmaps", BITMAPS, fmt)
