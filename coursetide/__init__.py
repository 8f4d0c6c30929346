"""Learning analytics on Spark: event ingest, daily learner progress, KPIs and checks."""

from .operators import *  # noqa: F403
from .operators import __all__ as _operators
from .plans import backfill, export_kpis, read_day_tables, refresh_day_tables, refresher, run_day
from .session import prepare
from .sources import (
    append_extract,
    compact_days,
    grow_numbers,
    kafka_records,
    partition_rows,
    publish,
    publish_between,
    publish_days,
    read_bronze,
    read_compacted,
    read_days,
    read_numbers,
    read_silver,
    replay_records,
    require_partition,
)
from .streaming import follow_silver, ingest, ingested

__all__ = [
    *_operators,
    "append_extract",
    "compact_days",
    "backfill",
    "export_kpis",
    "follow_silver",
    "grow_numbers",
    "ingest",
    "ingested",
    "kafka_records",
    "partition_rows",
    "prepare",
    "publish",
    "publish_between",
    "publish_days",
    "read_bronze",
    "read_compacted",
    "read_day_tables",
    "read_days",
    "read_numbers",
    "read_silver",
    "refresh_day_tables",
    "refresher",
    "replay_records",
    "require_partition",
    "run_day",
]
