"""What the schema leaves over: unknown fields, unreadable records, fields that get a column later."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

import coursetide as ct
from coursetide.schemas import BRONZE, LEFT_OVER

from .rows import event, record, records_of


def parsed(spark, *values, **options):
    rows = [record(value, offset=n) for n, value in enumerate(values)]
    return ct.parse_events(records_of(spark, rows), **options)


def left(df):
    rows = df.orderBy("offset").select(F.to_json("rest").alias("rest"), "bad_text", "bad_reason").collect()
    return [(r.rest and json.loads(r.rest), r.bad_text, r.bad_reason) for r in rows]


def test_columns_and_rows_are_those_of_bronze(spark):
    values = [event("1"), "garbage", None, event("2", new=1)]
    plain, more = parsed(spark, *values), parsed(spark, *values, left_over=True)
    assert more.columns == BRONZE.names + LEFT_OVER.names
    names = [n for n in BRONZE.names if n != "ingest_time"]
    assert sorted(map(str, more.select(*names).collect())) == sorted(map(str, plain.select(*names).collect()))


def test_unreadable_records_keep_text_and_reason(spark):
    values = ["garbage", "", "[1, 2]", "12", '{"event_id": "cut', None, event("1")]
    assert left(parsed(spark, *values, left_over=True)) == [
        (None, "garbage", "not JSON"),
        (None, "", "not JSON"),
        (None, "[1, 2]", "not an object"),
        (None, "12", "not an object"),
        (None, '{"event_id": "cut', "not JSON"),
        (None, None, "no value"),
        (None, None, None),
    ]


def test_a_field_of_another_type(spark):
    wrong = event("1", payload={"watch_seconds": "many", "video_id": "v1"})
    df = parsed(spark, wrong, left_over=True)
    (rest, text, reason), row = left(df)[0], df.first()
    assert rest is None and json.loads(text) == wrong and reason == "a field of another type"
    assert row.payload.watch_seconds is None and row.event_id == "1"


def test_unknown_fields(spark):
    values = [
        event("1", trace={"id": 7, "tags": ["a", None]}, payload={"score": 1.0, "device": "phone"}),
        event("2", zone=None),
        event("3", payload={"deep": {"er": [1, {"x": 2}]}}),
        {**event("4"), "payload": "text"},
        {**event("5"), "payload": None},
        {"other": 1},
    ]
    found = [rest for rest, _, _ in left(parsed(spark, *values, left_over=True))]
    assert found == [
        {"trace": {"id": 7, "tags": ["a", None]}, "payload": {"device": "phone"}},
        {"zone": None},
        {"payload": {"deep": {"er": [1, {"x": 2}]}}},
        None,
        None,
        {"other": 1},
    ]


def test_fields_of_the_rest(spark):
    df = parsed(spark, event("1", payload={"device": "phone", "n": 3}), event("2", payload={"n": "x"}), "garbage", left_over=True)
    got = df.orderBy("offset").select(
        ct.field_of_rest("payload.device", "string").alias("device"), ct.field_of_rest("payload.n", "int").alias("n")
    )
    assert [tuple(r) for r in got.collect()] == [("phone", 3), (None, None), (None, None)]


@pytest.mark.parametrize("left_over", [True, False])
def test_added_columns(spark, left_over):
    added = {"payload.device": "device string", "trace.id": "trace bigint"}
    df = parsed(spark, event("1", trace={"id": 5}, payload={"device": "d"}), event("2"), "garbage", added=added, left_over=left_over)
    assert df.columns == BRONZE.names + ["device", "trace"] + LEFT_OVER.names * left_over
    assert [(r.device, r.trace) for r in df.orderBy("offset").collect()] == [("d", 5), (None, None), (None, None)]


def test_a_field_gets_a_column_at_a_restart(spark, tmp_path):
    log, bronze, checkpoint = (str(tmp_path / n) for n in ("log", "bronze", "checkpoint"))

    def run(*values, **options):
        records_of(spark, [record(v) for v in values]).coalesce(1).write.mode("append").parquet(log)
        ct.ingest(ct.replay_records(spark, log), bronze, checkpoint, catch_up=True, **options).awaitTermination()

    run(event("1", payload={"device": "a"}))
    run(event("2", payload={"device": "b"}), "garbage", left_over=True)
    run(event("3", payload={"device": "c"}), left_over=True, added={"payload.device": "device string"})
    df = ct.read_bronze(spark, bronze, left_over=True, added=["device string"])
    device = F.coalesce("device", ct.field_of_rest("payload.device", "string")).alias("d")
    found = {r.event_id: (r.d, r.device, r.bad_text) for r in df.select("event_id", device, "device", "bad_text").collect()}
    assert found == {"1": (None, None, None), "2": ("b", None, None), "3": ("c", "c", None), None: (None, None, "garbage")}
    assert ct.read_bronze(spark, bronze).count() == 4  # readers that know of none of it
    merged = ct.read_bronze(spark, bronze, merge_schema=True)
    assert {"device", "rest", "bad_text"} <= set(merged.columns)


def test_no_rows(spark):
    assert left(parsed(spark, left_over=True)) == []
