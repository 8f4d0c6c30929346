"""Numbers for the values of columns, one after the other, that never change once they are given."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import NUMBERS
from ..session import few_rows, scratch_dir


def read_numbers(spark: SparkSession, path: str) -> DataFrame:
    """``column_name``, ``value`` and ``number``, from 1 in each column; no rows where there is no table yet."""
    try:
        return spark.read.schema(NUMBERS).parquet(path).select(*NUMBERS.names)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return few_rows(spark, [], NUMBERS)


def grow_numbers(table: DataFrame, path: str, columns: Iterable[str]) -> None:
    """Number the values of ``columns`` that have no number yet. Null has none.

    New values are stored first, and each gets the place in its stored file behind all files before it, so that numbers
    are dense without sorting the values in one task; only a count per file is sorted. A job that failed
    is run again with no harm, as numbers are appended in one commit per column. One job at a time may grow a table.
    """
    spark = table.sparkSession
    for column in columns:
        known = read_numbers(spark, path).where(F.col("column_name") == column)
        seen = table.select(F.col(column).cast("string").alias("value")).where("value is not null").distinct()
        staged = scratch_dir(spark, "numbers")
        place = F.monotonically_increasing_id()  # partition and place in it: 31 and 33 bits
        new = seen.join(known.select("value").hint("merge"), "value", "left_anti")
        new.withColumn("part", F.spark_partition_id()).withColumn("place", place.bitwiseAND((1 << 33) - 1)).write.parquet(staged)
        new = spark.read.schema("value string, part int, place long").parquet(staged)
        before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
        offsets = new.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("offset"))
        last = F.coalesce(known.select(F.max("number")).scalar(), F.lit(0))
        numbered = new.join(offsets.hint("merge"), "part").select(
            F.lit(column).alias("column_name"), "value", (last + F.col("offset") + F.col("place") + 1).alias("number")
        )
        numbered.write.mode("append").partitionBy("column_name").parquet(path)
