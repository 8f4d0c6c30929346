"""Schemas of the wire records and of the two tables, and the fixed value lists."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(**types: str) -> T.StructType:
    schema = T.StructType()
    for name, kind in types.items():
        schema = schema.add(name, kind)
    return schema


# The event types every healthy bronze table holds.
EVENT_TYPES = (
    "course_enrolled",
    "video_started",
    "video_completed",
    "quiz_attempted",
    "quiz_submitted",
    "article_viewed",
)

KAFKA_RECORD = _fields(
    key="binary",
    value="binary",
    topic="string",
    partition="integer",
    offset="long",
    timestamp="timestamp",
)

# Names and types of the wire format. One wide struct for all event types;
# fields of other types are null.
PAYLOAD = _fields(
    enroll_method="string",
    cohort="string",
    video_id="string",
    position_seconds="long",
    watch_seconds="long",
    quiz_id="string",
    questions="long",
    score="double",
    passed="boolean",
    article_id="string",
    read_seconds="long",
)

# Names and types of the wire format. The five fields every producer must set are declared non-null; a record that lacks
# one is still read, with null in its place.
ENVELOPE = (
    T.StructType()
    .add("schema_version", "string")
    .add("event_id", "string", nullable=False)
    .add("event_type", "string", nullable=False)
    .add("user_id", "string", nullable=False)
    .add("course_id", "string")
    .add("timestamp_iso", "string", nullable=False)
    .add("timestamp_ms", "long", nullable=False)
    .add("payload", PAYLOAD)
)

BRONZE = T.StructType([T.StructField(f.name, f.dataType) for f in ENVELOPE]) \
    .add("partition", "integer") \
    .add("offset", "long") \
    .add("event_time", "timestamp") \
    .add("ingest_time", "timestamp") \
    .add("event_date", "date")

# What parsing by the schema leaves over: fields that are in no schema, and the text of records that could not be read.
LEFT_OVER = _fields(rest="variant", bad_text="string", bad_reason="string")

# Silver counter column -> the event type it counts.
COUNTERS = {
    "courses_enrolled": "course_enrolled",
    "videos_started": "video_started",
    "videos_completed": "video_completed",
    "quizzes_attempted": "quiz_attempted",
    "quizzes_submitted": "quiz_submitted",
    "articles_viewed": "article_viewed",
}

SILVER = _fields(
    user_id="string",
    event_date="date",
    **dict.fromkeys(COUNTERS, "long"),
    unique_courses_accessed="long",
    total_activities="long",
    avg_quiz_score="double",
    total_watch_seconds="long",
    video_completion_rate_percent="double",
    quiz_completion_rate_percent="double",
    engagement_level="string",
    is_active_learner="boolean",
    completion_score="double",
    processing_timestamp="timestamp",
    processing_date="date",
)

# What days add to KPIs and distinct counts, and the numbers of values.
STATES = _fields(
    source="string",
    event_date="date",
    measure="string",
    key="string",
    records="long",
    valued="long",
    total="double",
    whole="long",
)

BITMAPS = _fields(column_name="string", event_date="date", bucket="long", bits="binary")

NUMBERS = _fields(column_name="string", value="string", number="long")

# Compacted days: where the latest version of each lies and which files of the stream it holds.
VERSIONS = _fields(event_date="date", folder="string", source="string", version="long")

# The batch that a stream has worked off last.
FINISHED = _fields(query_id="string", batch_id="long")

# Sketches of a day's columns.
SKETCHES = _fields(
    event_date="date",
    column_name="string",
    records="long",
    nulls="long",
    least="double",
    greatest="double",
    distinct="binary",
    quantiles="binary",
)
