"""Hand-written bronze and silver rows."""

from __future__ import annotations

import json
from datetime import date, datetime, timezone

from coursetide.schemas import BRONZE, KAFKA_RECORD, PAYLOAD

DAY = date(2025, 1, 2)


def bronze_row(kind=None, user="u1", course="c1", day=DAY, **payload):
    assert set(payload) <= set(PAYLOAD.names)
    values = dict.fromkeys(BRONZE.names)
    values.update(
        event_type=kind,
        user_id=user,
        course_id=course,
        event_date=day,
        timestamp_iso=f"{day}T10:00:00+00:00" if day else None,
        payload=tuple(payload.get(name) for name in PAYLOAD.names),
    )
    return tuple(values[name] for name in BRONZE.names)


def bronze_of(spark, rows):
    return spark.createDataFrame(list(rows), BRONZE)


def record(value, partition=0, offset=0, key="u1"):
    if isinstance(value, dict):
        value = json.dumps(value)
    return (
        key.encode(),
        None if value is None else value.encode(),
        "lms_events",
        partition,
        offset,
        datetime(2025, 1, 2, tzinfo=timezone.utc),
    )


def records_of(spark, rows):
    return spark.createDataFrame(list(rows), KAFKA_RECORD)


def event(event_id="e1", kind="article_viewed", iso="2025-01-02T10:00:00+00:00", payload=None, **extra):
    return {
        "schema_version": "v1",
        "event_id": event_id,
        "event_type": kind,
        "user_id": "u1",
        "course_id": "c1",
        "timestamp_iso": iso,
        "timestamp_ms": 1735812000000,
        "payload": payload or {},
        **extra,
    }
