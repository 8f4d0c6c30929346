from __future__ import annotations

import csv

import pytest

import coursetide as ct
from coursetide.fixtures import lms_events

from .conftest import TESTDATA
from .rows import bronze_of, bronze_row

METRIC_DATE = "2025-01-02"


def rows_of(folder):
    """Header and rows of the extract's files, in the order of their names."""
    files = sorted(folder.glob("*.csv"))
    tables = [list(csv.reader(file.open())) for file in files]
    headers = {tuple(table[0]) for table in tables}
    assert len(headers) == 1
    return headers.pop(), [tuple(row) for table in tables for row in table[1:]]


@pytest.fixture
def bronze(spark):
    return bronze_of(
        spark,
        [
            bronze_row("quiz_submitted", course="a", score=50.0, passed=False, user="u1"),
            bronze_row("quiz_submitted", course="b", score=70.0, passed=True, user="u2"),
            bronze_row("quiz_submitted", course="a", score=60.0, passed=True, user="u2"),
            bronze_row("video_completed", video_id="v1", watch_seconds=10),
            bronze_row("video_completed", video_id="v2", watch_seconds=20),
        ],
    )


def test_three_extracts(spark, bronze, tmp_path):
    ct.export_kpis(bronze, str(tmp_path), "a", METRIC_DATE)
    scores = tmp_path / "avg_quiz_score_per_course" / "metric_date=2025-01-02"
    assert rows_of(scores) == (("course_id", "avg_quiz_score"), [("b", "70.0"), ("a", "55.0")])
    videos = tmp_path / "most_watched_videos" / "metric_date=2025-01-02"
    assert rows_of(videos) == (("video_id", "total_watch_seconds"), [("v2", "20"), ("v1", "10")])
    completion = tmp_path / "course_completion" / "metric_date=2025-01-02" / "course_id=a"
    header, rows = rows_of(completion)
    assert header == ("definition", "users")
    assert sorted(rows) == [("loose_any_quiz", "2"), ("strict_passed", "1")]


def test_second_run_appends(spark, bronze, tmp_path):
    for _ in range(2):
        ct.export_kpis(bronze, str(tmp_path), "a", METRIC_DATE)
    extract = spark.read.option("header", True).csv(str(tmp_path / "avg_quiz_score_per_course"))
    assert extract.count() == 4


@pytest.mark.parametrize("files", [None, 1])
def test_full_ranking_keeps_its_order(spark, tmp_path, files):
    bronze = lms_events(spark, str(TESTDATA / "sf0.01"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ct.export_kpis(bronze, str(tmp_path), "ct_anatomy_fundamentals", METRIC_DATE, files=files)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    folder = tmp_path / "most_watched_videos" / "metric_date=2025-01-02"
    assert len(list(folder.glob("*.csv"))) == (1 if files else 8)
    _, rows = rows_of(folder)
    expected = [(r.video_id, str(r.total_watch_seconds)) for r in ct.most_watched_videos(bronze).collect()]
    assert rows == expected and len(rows) == 100
