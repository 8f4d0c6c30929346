"""Records of the event log to bronze rows. Map-only, the same for batch and stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import event_day, event_instant
from ..schemas import BRONZE, ENVELOPE, PAYLOAD
from ..session import require_utc


_BAD = "_bad"


def decode_records(raw: DataFrame) -> DataFrame:
    """Key and value as text, with the place of the record in the log."""
    return raw.selectExpr(
        "CAST(key AS STRING) AS message_key",
        "CAST(value AS STRING) AS message",
        "partition",
        "offset",
    )


def parse_events(raw: DataFrame, left_over: bool = False, added: Mapping[str, str] | None = None) -> DataFrame:
    """One bronze row for each record.

    Nothing is filtered: text that is no event gives a row with a null envelope and a
    null ``event_date``, a field of the wrong type is null by itself, and repeated
    event ids stay.

    With ``left_over`` nothing of a record is lost either. ``rest`` holds the fields that are in no schema, those of the
    payload under ``payload``, as a VARIANT (null if there are none); ``bad_text`` the record where it, or a
    field of it, could not be read, and ``bad_reason`` why. ``added`` makes columns of fields that came later: the
    column's name and type by the field's path, such as ``{"payload.device": "device string"}``; they are
    null where the field is absent or of another type.
    """
    require_utc(raw)
    message = F.col("value").cast("string")
    if left_over:
        schema = T.StructType([*ENVELOPE, T.StructField(_BAD, T.StringType())])
        event = F.from_json(message, schema, {"columnNameOfCorruptRecord": _BAD})
    else:
        event = F.from_json(message, ENVELOPE)
    columns = [event.alias("event"), "partition", "offset"]
    if left_over or added:
        columns += [message.alias("message"), F.try_parse_json(message).alias("whole")]
    events = raw.select(*columns)
    further = {}
    for path, column in (added or {}).items():
        name, kind = column.split(None, 1)
        further[name] = F.try_variant_get("whole", f"$.{path}", kind)
    if left_over:
        further |= _left_over()
    parsed = events.select("event.*", "partition", "offset", *(column.alias(name) for name, column in further.items()))
    return (
        parsed.withColumn("event_time", event_instant(F.col("timestamp_iso")))
        .withColumn("ingest_time", F.current_timestamp())
        .withColumn("event_date", event_day(F.col("event_time")))
        .select(*BRONZE.names, *further)
    )


def field_of_rest(path: str, kind: str) -> Column:
    """A field of stored rows that no schema has, such as ``payload.device``; null where it is absent or of another type."""
    return F.try_variant_get("rest", f"$.{path}", kind)


def _left_over() -> dict[str, Column]:
    def outside(path: str, known: list[str]) -> Column:
        fields = F.try_variant_get("whole", path, "map<string,variant>")
        return F.map_filter(fields, lambda name, _: ~name.isin(known))

    of_event, of_payload = outside("$", ENVELOPE.names), outside("$.payload", PAYLOAD.names)
    inner = F.when(F.size(of_payload) > 0, F.map_from_arrays(F.array(F.lit("payload")), F.array(F.to_variant_object(of_payload))))
    nothing = F.create_map().cast("map<string,variant>")
    rest = F.map_concat(F.coalesce(of_event, nothing), F.coalesce(inner, nothing))
    kind = F.schema_of_variant("whole")
    reason = (
        F.when(F.col("message").isNull(), "no value")
        .when(F.col("whole").isNull(), "not JSON")
        .when(~kind.startswith("OBJECT"), "not an object")
        .when(F.col(f"event.{_BAD}").isNotNull(), "a field of another type")
    )
    return {
        "rest": F.when(F.size(rest) > 0, F.to_variant_object(rest)),
        "bad_text": F.when(reason.isNotNull(), F.col("message")),
        "bad_reason": reason,
    }
