"""What Spark makes of the queries: pruning, pushdown, and what must not be in a plan."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

import __spark_entry__ as registry
import coursetide as ct
from coursetide.fixtures import as_records, lms_events
from coursetide.sources import kafka_options

from .conftest import TESTDATA

FOLDER = str(TESTDATA / "sf0.001")


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "bronze")
    lms_events(spark, FOLDER).repartition("event_date").write.partitionBy("event_date").parquet(path)
    return ct.read_bronze(spark, path)


COSTLY = ("Python", "Pandas", "Arrow", "NestedLoop", "Cartesian", "BroadcastExchange")


@pytest.mark.parametrize("name", sorted(registry.analytics_queries()))
def test_no_costly_operator(spark, name):
    """In the result's plan and in those of all that the query writes on its way."""
    executed = spark._jsparkSession.sharedState().statusStore()
    before = executed.executionsCount()
    plans = [plan_of(registry.queries()[name](spark, FOLDER))]
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    written = executed.executionsList(before, 1000)
    plans += [written.apply(n).physicalPlanDescription() for n in range(written.size())]
    for plan in plans:
        for operator in COSTLY:
            assert operator not in plan, operator


def test_a_day_reads_one_partition_and_five_columns(bronze):
    plan = plan_of(ct.user_progress(bronze, "2024-01-15"))
    assert re.search(r"PartitionFilters: \[.*event_date#\d+ = 2024-01-15", plan)
    assert re.search(
        r"ReadSchema: struct<event_type:string,user_id:string,course_id:string,"
        r"payload:struct<watch_seconds:bigint,score:double>>",
        plan,
    )


def test_a_range_of_days_is_pruned(bronze):
    plan = plan_of(ct.user_progress_between(bronze, "2024-01-03", "2024-01-07"))
    assert re.search(r"PartitionFilters: \[.*>= 2024-01-03.*<= 2024-01-07", plan)


def test_progress_combines_before_both_shuffles(bronze):
    plan = plan_of(ct.user_progress(bronze, "2024-01-15"))
    tree = plan[: plan.index("(1)") + plan[plan.index("(1)") :].index("\n\n")]
    assert tree.count("Exchange") == 2 and tree.count("HashAggregate") == 4


def test_completion_is_pruned_and_pushed_down(bronze):
    for day in ("2024-01-15", None):
        plan = plan_of(ct.course_completion(bronze, "ct_anatomy_fundamentals", day))
        assert re.search(r"PartitionFilters: \[.*event_date#\d+ = ", plan)
        assert "EqualTo(event_type,quiz_submitted)" in plan
        assert "EqualTo(course_id,ct_anatomy_fundamentals)" in plan


def test_rankings_push_down_and_read_nested_fields_only(bronze):
    videos = plan_of(ct.most_watched_videos(bronze))
    assert "EqualTo(event_type,video_completed)" in videos
    assert "payload:struct<video_id:string,watch_seconds:bigint>" in videos
    for head in (ct.top_courses(bronze), ct.most_watched_videos(bronze, k=20)):
        assert "TakeOrderedAndProject" in plan_of(head)


def test_counts_read_no_columns(bronze):
    assert "ReadSchema: struct<>" in plan_of(ct.partition_rows(bronze))
    assert "ReadSchema: struct<>" in plan_of(ct.table_profile(bronze))


def test_health_reads_each_column_once(spark, bronze, tmp_path):
    ct.backfill(bronze, str(tmp_path / "silver"), "2024-01-01", "2024-01-02")
    plan = plan_of(ct.pipeline_health(bronze, ct.read_silver(spark, str(tmp_path / "silver"))))
    read = re.findall(r"ReadSchema: struct<(.*)>", plan)
    assert sorted(read) == ["", "", "course_id:string", "event_type:string", "user_id:string"]
    assert "Expand" not in plan


def test_ingest_is_map_only(spark, tmp_path):
    as_records(lms_events(spark, FOLDER)).write.parquet(str(tmp_path / "log"))
    for gather in (False, True):
        out = str(tmp_path / str(gather))
        raw = ct.replay_records(spark, str(tmp_path / "log"))
        query = ct.ingest(raw, f"{out}/bronze", f"{out}/checkpoint", catch_up=True, gather_days=gather)
        query.awaitTermination()
        assert ("Exchange" in query._jsq.explainInternal(False)) == gather


def test_parse_reads_json_once_for_each_record(spark):
    plan = plan_of(registry.bronze_parse(spark, FOLDER))
    assert plan.count("from_json(") == 1 and "Exchange" not in plan


def test_kafka_options():
    assert kafka_options("broker:9092") == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "lms_events",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "2000000",
    }
    given = kafka_options(
        "b",
        "t",
        starting_offsets="latest",
        fail_on_data_loss=True,
        max_offsets_per_trigger=1000,
        min_partitions=40,
        more={"kafka.security.protocol": "SASL_SSL", "includeHeaders": "true"},
    )
    assert (given["subscribe"], given["startingOffsets"], given["failOnDataLoss"]) == ("t", "latest", "true")
    assert (given["maxOffsetsPerTrigger"], given["minPartitions"]) == ("1000", "40")
    assert (given["kafka.security.protocol"], given["includeHeaders"]) == ("SASL_SSL", "true")
    for wrong in ({"max_offsets_per_trigger": 0}, {"min_partitions": 0}):
        with pytest.raises(ValueError, match="at least 1"):
            kafka_options("b", **wrong)
