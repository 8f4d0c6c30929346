"""Closed days of the stream's table in few, clustered files, beside it.

The stream's files stay as they are. A compacted day is a folder of its own that is never changed: a newer version
is another folder, and a small table names the folder of each day's latest version. So readers that began with the old
one end with it, and a job that failed leaves a folder that nobody names. A day that got late files since is read
from the stream's table until it is compacted again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import date
from urllib.parse import unquote
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BRONZE, VERSIONS
from ..session import as_day, few_rows
from .tables import on_days, read_bronze

#: Bytes of stored rows in a file, and in the row groups that a filter can pass over.
FILE_BYTES, GROUP_BYTES = 512 << 20, 32 << 20
#: Columns that filters within a day name.
CLUSTERED = ("event_type", "course_id", "user_id")
_BITS = 10

Day = date | None


def compact_days(
    spark: SparkSession,
    bronze_path: str,
    path: str,
    until: date | str,
    cluster_by: Sequence[str] = CLUSTERED,
    file_bytes: int = FILE_BYTES,
    group_bytes: int = GROUP_BYTES,
    together: int = 4,
) -> list[Day]:
    """Compacts every day before ``until`` whose files have changed since it was compacted, and gives those days.

    Rows without a day are compacted too. Each day is a job, ``together`` of them at a time. With ``cluster_by`` rows
    are dealt by a space-filling curve over these columns, so that a filter on any of them meets few row
    groups, and the columns get Bloom filters. Without, the scan packs a day's files by their sizes into tasks of
    ``file_bytes``, each of which writes one file, and nothing is shuffled. Run by one job at a time.
    """
    before = as_day(until)
    files = {day: names for day, names in _stream_files(spark, bronze_path).items() if day is None or day < before}
    known = _versions(spark, path)
    stale = [day for day, names in files.items() if day not in known or known[day].source != _mark(names)]
    stale.sort(key=lambda day: (day is not None, day))
    sizes = _sizes(read_bronze(spark, bronze_path).where(on_days(stale))) if cluster_by and stale else {}

    def compact(day: Day) -> tuple:
        folder = f"{path}/rows/{_named(day)}/{uuid4().hex}"
        # the table's own schema has the day; the folder's name has it here
        rows = spark.read.schema(BRONZE).parquet(bronze_path).where(on_days([day])).drop("event_date")
        if cluster_by:
            parts = max(1, -(-sizes.get(day, 0) // file_bytes))
            place = curve(cluster_by)
            rows = rows.withColumn("_place", place).repartitionByRange(parts, "_place", "timestamp_ms")
            rows = rows.sortWithinPartitions("_place", "timestamp_ms").drop("_place")
        writer = rows.write.option("parquet.block.size", group_bytes)
        for column in cluster_by:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", True)
        writer.parquet(folder)
        return day, folder.removeprefix(f"{path}/"), _mark(files[day]), known[day].version + 1 if day in known else 0

    with _packing(spark, file_bytes), ThreadPoolExecutor(max_workers=together) as pool:
        done = list(pool.map(compact, stale))
    if done:
        few_rows(spark, done, VERSIONS).coalesce(1).write.mode("append").parquet(f"{path}/versions")
    return stale


def read_compacted(spark: SparkSession, bronze_path: str, path: str) -> DataFrame:
    """The rows of the stream's table: from compacted files where they hold all of a day, else from the stream's."""
    files = _stream_files(spark, bronze_path)
    current = {day: v for day, v in _versions(spark, path).items() if v.source == _mark(files.get(day, []))}
    live = read_bronze(spark, bronze_path)
    if not current:
        return live
    folders = [f"{path}/{v.folder}" for v in current.values()]
    rows = spark.read.schema(BRONZE).option("basePath", f"{path}/rows").option("recursiveFileLookup", False).parquet(*folders)
    rest = [day for day in files if day not in current]
    compacted = rows.select(*BRONZE.names)
    return compacted.unionByName(live.where(on_days(rest))) if rest else compacted


def curve(columns: Iterable[str]) -> Column:
    """A number that interleaves the bits of the columns' hashes: rows with near numbers share values in each."""
    columns = list(columns)
    hashes = [F.pmod(F.xxhash64(F.col(name)), F.lit(1 << _BITS)) for name in columns]
    place = F.lit(0).cast("long")
    for bit in range(_BITS):
        for n, value in enumerate(hashes):
            one = F.shiftright(value, bit).bitwiseAND(F.lit(1).cast("long"))
            place = place.bitwiseOR(F.shiftleft(one, bit * len(columns) + n))
    return place


def _stream_files(spark: SparkSession, path: str) -> dict[Day, list[str]]:
    """Files of each day, from the table's own list: no job, no footer read."""
    days: dict[Day, list[str]] = {}
    for file in spark.read.schema(BRONZE).parquet(path).inputFiles():
        named = re.search(r"/event_date=([^/]+)/", unquote(file))
        if named:
            day = None if named[1].startswith("__") else date.fromisoformat(named[1])
            days.setdefault(day, []).append(file.rsplit("/", 1)[1])
    return days


def _sizes(rows: DataFrame) -> Mapping[Day, int]:
    """Stored bytes of each day: one row per file, no columns."""
    files = rows.select("event_date", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("n")).distinct()
    return {r.event_date: r.n for r in files.groupBy("event_date").agg(F.sum("n").alias("n")).collect()}


def _mark(names: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest()


def _named(day: Day) -> str:
    return f"event_date={'__HIVE_DEFAULT_PARTITION__' if day is None else day}"


def _versions(spark: SparkSession, path: str) -> dict:
    """The latest version of each day, one row for each."""
    try:
        table = spark.read.schema(VERSIONS).parquet(f"{path}/versions")
        latest = table.groupBy("event_date").agg(F.max_by(F.struct(*VERSIONS.names), "version").alias("v")).select("v.*")
        return {r.event_date: r for r in latest.collect()}
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}


@contextmanager
def _packing(spark: SparkSession, size: int) -> Iterator[None]:
    """Scans that pack whole files into tasks of a size, for the time of one compaction."""
    wanted = {
        "spark.sql.files.maxPartitionBytes": str(size),
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "1",
    }
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
