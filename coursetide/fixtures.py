"""Learning events derived from the generic ``events`` table of the test data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import BRONZE, ENVELOPE, PAYLOAD

# The courses on offer.
COURSES = (
    "ct_anatomy_fundamentals",
    "ct_physics_technology",
    "radiation_safety_practices",
    "image_acquisition_procedures",
    "contrast_administration_protocols",
    "patient_positioning_techniques",
    "quality_assurance_procedures",
    "ct_pathology_recognition",
)
# The cohorts learners enrol in.
COHORTS = ("A", "B", "C")
TOPIC = "lms_events"
TOPIC_PARTITIONS = 3


def lms_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``events`` as one learning event in the bronze schema."""
    k = F.get_json_object("props", "$.k").cast("long")
    source = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("k", k)
    kind, k, value = F.col("kind"), F.col("k"), F.col("value")
    typed = source.withColumn("kind", _event_type(F.col("event_type"), k))

    def only(column: Column, *kinds: str) -> Column:
        return F.when(kind.isin(*kinds), column)

    def label(prefix: str, number: Column) -> Column:
        return F.concat(F.lit(prefix), number.cast("string"))

    seconds = F.floor(value).cast("long")
    video, quiz = ("video_started", "video_completed"), ("quiz_attempted", "quiz_submitted")
    payload = {
        "enroll_method": only(F.when(k % 2 == 0, "self_service").otherwise("assigned"), "course_enrolled"),
        "cohort": only(
            F.element_at(F.array(*map(F.lit, COHORTS)), (k % len(COHORTS) + 1).cast("int")), "course_enrolled"
        ),
        "video_id": only(label("v", 1000 + k), *video),
        "position_seconds": only(F.lit(0).cast("long"), "video_started"),
        "watch_seconds": only(seconds + 30, "video_completed"),
        "quiz_id": only(label("q", 100 + k), *quiz),
        "questions": only(5 + k % 16, "quiz_attempted"),
        "score": only(F.least(F.floor(value), F.lit(100)).cast("double"), "quiz_submitted"),
        "passed": only(value >= 60, "quiz_submitted"),
        "article_id": only(label("a", 1000 + k), "article_viewed"),
        "read_seconds": only(seconds + 10, "article_viewed"),
    }
    instant = F.col("ts").cast("timestamp")
    course = F.element_at(F.array(*map(F.lit, COURSES)), (k % len(COURSES) + 1).cast("int"))
    return typed.select(
        F.lit("v1").alias("schema_version"),
        F.col("event_id").cast("string").alias("event_id"),
        kind.alias("event_type"),
        label("ct_student_", 1000 + F.col("user_id")).alias("user_id"),
        course.alias("course_id"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")).alias("timestamp_iso"),
        F.unix_millis(instant).alias("timestamp_ms"),
        F.struct(*(payload[name].alias(name) for name in PAYLOAD.names)).alias("payload"),
        (F.col("user_id") % TOPIC_PARTITIONS).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        instant.alias("event_time"),
        F.current_timestamp().alias("ingest_time"),
        F.to_date("ts").alias("event_date"),
    ).select(*BRONZE.names)


def as_records(events: DataFrame) -> DataFrame:
    """Events re-encoded as the JSON records of the event log."""
    return events.select(
        F.col("user_id").cast("binary").alias("key"),
        F.to_json(F.struct(*ENVELOPE.names)).cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        "partition",
        "offset",
        F.col("event_time").alias("timestamp"),
    )


def stray_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole texts of ``documents`` as records that are no events."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.lit(None).cast("binary").alias("key"),
        F.col("text").cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("doc_id") % TOPIC_PARTITIONS).cast("int").alias("partition"),
        F.col("doc_id").cast("long").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    )


def _event_type(name: Column, k: Column) -> Column:
    viewed = F.when(k % 2 == 0, "video_started").otherwise("article_viewed")
    return (
        F.when(name == "signup", "course_enrolled")
        .when(name == "error", "video_completed")
        .when(name == "click", "quiz_attempted")
        .when(name == "purchase", "quiz_submitted")
        .when(name == "view", viewed)
    )
