"""Bronze and silver tables on storage: reading, replacing whole days, checking days.

``fmt`` is ``parquet`` or, with its jar on the class path, ``delta``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import BRONZE, LEFT_OVER, SILVER
from ..session import as_day, few_rows


#: Spark's name for the folder of rows without a day.
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def read_bronze(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    merge_schema: bool = False,
    left_over: bool = False,
    added: Iterable[str] = (),
) -> DataFrame:
    """Bronze rows; with ``merge_schema`` also columns that later files added.

    ``left_over`` and ``added`` (names with types, as in :func:`coursetide.parse_events`) read such columns by a
    known schema, without looking into every file; rows from before they were stored have null.
    """
    if merge_schema:
        return spark.read.format(fmt).option("mergeSchema", True).load(path)
    schema = StructType([*BRONZE, *(LEFT_OVER if left_over else [])])
    for column in added:
        name, kind = column.split(None, 1)
        schema = schema.add(name, kind)
    return _read(spark, path, fmt, schema)


def read_silver(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, fmt, SILVER)


def read_days(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """Any other table that is stored by day, with a known schema."""
    return _read(spark, path, fmt, schema)


def publish(
    silver: DataFrame,
    path: str,
    run_date: date | str,
    fmt: str = "parquet",
    files: int | None = None,
    rows_per_file: int | None = None,
    file_bytes: int | None = None,
) -> None:
    """Replace one day of the silver table, creating the table if need be.

    Rows of other days are not written. No rows for the day leaves the day empty.
    """
    publish_between(silver, path, run_date, run_date, fmt, files, rows_per_file, file_bytes)


def publish_day_if(
    silver: DataFrame,
    path: str,
    run_date: date | str,
    gate: Callable[[int], None],
    fmt: str = "parquet",
    files: int | None = None,
    rows_per_file: int | None = None,
    file_bytes: int | None = None,
) -> None:
    """As :func:`publish`, with a check of the number of rows written. It runs before the day is emptied for want of rows."""
    day = as_day(run_date)
    chosen, predicate = F.col("event_date") == F.lit(day), _days_predicate(day, day)
    _replace(silver, path, chosen, predicate, 1, fmt, files, rows_per_file, file_bytes, gate)


def publish_between(
    silver: DataFrame,
    path: str,
    start: date | str,
    end: date | str,
    fmt: str = "parquet",
    files: int | None = None,
    rows_per_file: int | None = None,
    file_bytes: int | None = None,
) -> None:
    """Replace every day from ``start`` to ``end`` in one job, days without rows included.

    ``files`` is the most files a day gets. Left out, a file is written of about ``file_bytes``
    of shuffled rows (the session's advisory size unless given), which Parquet then makes smaller.
    """
    start, end = as_day(start), as_day(end)
    if start > end:
        raise ValueError(f"the range begins on {start}, after its end on {end}")
    in_range = F.col("event_date").between(F.lit(start), F.lit(end))
    _replace(silver, path, in_range, _days_predicate(start, end), len(_days(start, end)), fmt, files, rows_per_file, file_bytes)


def publish_days(
    table: DataFrame,
    path: str,
    days: Iterable[date | str | None],
    fmt: str = "parquet",
    files: int | None = None,
    rows_per_file: int | None = None,
    file_bytes: int | None = None,
) -> None:
    """Replace the given days in one job, as :func:`publish_between` does those of a range; no days change nothing.

    The table may be any that has an ``event_date``; None stands for the rows without one.
    """
    wanted = {None if day is None else as_day(day) for day in days}
    if wanted:
        _replace(table, path, on_days(wanted), _listed_predicate(wanted), len(wanted), fmt, files, rows_per_file, file_bytes)


def on_days(days: Iterable[date | str | None]) -> Column:
    """Whether a row belongs to one of the days, None being those without a day. Prunes partitions."""
    days = list(days)
    named = F.col("event_date").isin([as_day(day) for day in days if day is not None])
    return named | F.col("event_date").isNull() if None in days else named


def _replace(
    table: DataFrame,
    path: str,
    chosen: Column,
    predicate: str,
    days: int,
    fmt: str,
    files: int | None,
    rows_per_file: int | None,
    file_bytes: int | None,
    gate: Callable[[int], None] | None = None,
) -> None:
    """Replaces the days that ``chosen`` and, for Delta, ``predicate`` hold of.

    ``gate`` is given the number of rows that were written, counted on their way, before any day is emptied: what it
    raises leaves days without new rows as they were. Delta replaces at commit, so there it can't.
    """
    for name, value in (("files", files), ("rows_per_file", rows_per_file), ("file_bytes", file_bytes)):
        if value is not None and value < 1:
            raise ValueError(f"{name} is {value}, and must be at least 1")
    spark = table.sparkSession
    made = Observation()
    rows = _laid_out(table.where(chosen).observe(made, F.count(F.lit(1)).alias("rows")), days, files)
    if fmt == "delta":
        writer = _day_writer(rows, rows_per_file).format("delta")
        with _writing(spark, file_bytes):
            writer.option("replaceWhere", predicate).save(path)
        if gate is not None:
            gate(observed(made, "rows"))
        return

    # Dynamic overwrite swaps in the new files at commit, so a failed job leaves the old
    # days in place. It does not touch days that got no rows. A single day got none if no rows were written. Of several,
    # those without still have the files they had before, as file names are new with every job. They are emptied after.
    before = {} if days == 1 else _day_files(spark, path, chosen, rows.schema)
    writer = _day_writer(rows, rows_per_file).option("partitionOverwriteMode", "dynamic")
    with _writing(spark, file_bytes):
        writer.parquet(path)
    written = observed(made, "rows")
    if gate is not None:
        gate(written)
    if days == 1:
        before = {} if written else _day_files(spark, path, chosen, rows.schema)
        after = {}
    else:
        after = _day_files(spark, path, chosen, rows.schema) if before else {}
    _empty_days(spark, path, [day for day, name in before.items() if after.get(day) == name or days == 1], rows.schema)


def observed(observation: Observation, name: str) -> int:
    """A count taken while a job ran."""
    return observation.get[name]


def partition_rows(
    table: DataFrame, start: date | str | None = None, end: date | str | None = None
) -> DataFrame:
    """Row count of each day that has rows, over all days or a range of them.

    Over all days, records without a day are counted too, under a null day.
    """
    days = table
    if start is not None:
        days = days.where(F.col("event_date") >= F.lit(as_day(start)))
    if end is not None:
        days = days.where(F.col("event_date") <= F.lit(as_day(end)))
    return days.groupBy("event_date").agg(F.count(F.lit(1)).alias("records")).orderBy("event_date")


def require_partition(table: DataFrame, day: date | str) -> None:
    """Raise unless the table has a row for the day; stops at the first one found."""
    if table.where(F.col("event_date") == F.lit(as_day(day))).isEmpty():
        raise LookupError(f"no rows for event_date={as_day(day)}")


def _read(spark: SparkSession, path: str, fmt: str, schema: StructType) -> DataFrame:
    reader = spark.read.format(fmt)
    if fmt == "parquet":
        reader = reader.schema(schema)
    return reader.load(path).select(*schema.names)


def _laid_out(rows: DataFrame, days: int, files: int | None) -> DataFrame:
    if files is not None:
        return rows.repartition(days * files, "event_date", F.pmod(F.hash(_first_key(rows)), F.lit(files)))
    # Gathers each day, and leaves it to adaptive execution to cut a day into tasks of its
    # advisory size: the number of files follows the data, not the number of cores.
    return rows.hint("rebalance", "event_date")


def _first_key(rows: DataFrame) -> str:
    return next(name for name in rows.columns if name != "event_date")


def _day_writer(rows: DataFrame, rows_per_file: int | None) -> DataFrameWriter:
    writer = rows.write.mode("overwrite").partitionBy("event_date")
    return writer if rows_per_file is None else writer.option("maxRecordsPerFile", rows_per_file)


def _listed_predicate(days: Iterable[date | None]) -> str:
    named = ", ".join(f"date'{day}'" for day in sorted(day for day in days if day is not None))
    parts = [f"event_date IN ({named})"] if named else []
    return " OR ".join(parts + ["event_date IS NULL"] * (None in days))


def _days_predicate(start: date, end: date) -> str:
    return f"event_date >= date'{start}' AND event_date <= date'{end}'"


#: Adaptive execution takes empty parts out of a plan, and with them the counts taken there; a write goes without that.
_KEEP_EMPTY = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"


@contextmanager
def _writing(spark: SparkSession, size: int | None) -> Iterator[None]:
    """For the time of one write: the size to which adaptive execution gathers and cuts, and empty parts left in."""
    rules = "spark.sql.adaptive.optimizer.excludedRules"
    excluded = [rule for rule in (spark.conf.get(rules, None) or "").split(",") if rule]
    wanted = {rules: ",".join([*excluded, _KEEP_EMPTY])}
    if size is not None:
        wanted["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(size)
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _day_files(spark: SparkSession, path: str, chosen: Column, schema: StructType) -> dict[date | None, str]:
    """A file name of each chosen day that has rows: at most one row a day, no column read."""
    try:
        table = spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    name = F.min("_metadata.file_name").alias("name")
    return {r.event_date: r.name for r in table.where(chosen).groupBy("event_date").agg(name).collect()}


def _empty_days(spark: SparkSession, path: str, days: list[date | None], schema: StructType) -> None:
    """Writes a file without rows for each day, a few days at a time."""

    def empty(day: date | None) -> None:
        nothing = few_rows(spark, [], schema).drop("event_date")
        nothing.write.mode("overwrite").parquet(f"{path}/event_date={_NO_DAY if day is None else day}")

    if days:
        with ThreadPoolExecutor(max_workers=8) as pool:
            list(pool.map(empty, days))


def _days(start: date, end: date) -> list[date]:
    return [start + timedelta(days=n) for n in range((end - start).days + 1)]
