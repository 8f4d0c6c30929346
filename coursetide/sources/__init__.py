from .compact import compact_days, curve, read_compacted
from .extracts import append_extract
from .numbers import grow_numbers, read_numbers
from .records import kafka_options, kafka_records, replay_records
from .tables import (
    observed,
    on_days,
    partition_rows,
    publish,
    publish_between,
    publish_day_if,
    publish_days,
    read_bronze,
    read_days,
    read_silver,
    require_partition,
)

__all__ = [
    "append_extract",
    "compact_days",
    "curve",
    "grow_numbers",
    "kafka_options",
    "kafka_records",
    "observed",
    "on_days",
    "partition_rows",
    "publish",
    "publish_between",
    "publish_day_if",
    "publish_days",
    "read_bronze",
    "read_compacted",
    "read_days",
    "read_numbers",
    "read_silver",
    "replay_records",
    "require_partition",
]
