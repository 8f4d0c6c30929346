"""A third of all rows on one learner, course and video, against plain Python."""

from __future__ import annotations

from collections import Counter, defaultdict
from random import Random

import pytest

import coursetide as ct
from coursetide.schemas import EVENT_TYPES

from .rows import DAY, bronze_of, bronze_row


@pytest.fixture(scope="module")
def drawn():
    random = Random(7)
    rows = []
    for n in range(6000):
        hot = n % 3 == 0
        rows.append(
            {
                "kind": random.choice(EVENT_TYPES),
                "user": "hot" if hot else f"u{random.randrange(900)}",
                "course": "c-hot" if hot else f"c{random.randrange(40)}",
                "video_id": "v-hot" if hot else f"v{random.randrange(300)}",
                "watch_seconds": random.randrange(1800),
                "score": float(random.randrange(101)),
                "passed": random.random() < 0.2,
            }
        )
    return rows


@pytest.fixture(scope="module")
def bronze(spark, drawn):
    return bronze_of(spark, [bronze_row(**row) for row in drawn]).repartition(8)


def test_progress(bronze, drawn):
    groups = defaultdict(list)
    for row in drawn:
        groups[row["user"]].append(row)
    result = {r.user_id: r for r in ct.user_progress(bronze, DAY).collect()}
    assert result.keys() == groups.keys()
    assert result["hot"].total_activities == len(drawn) / 3
    for user, rows in groups.items():
        mine = result[user]
        assert mine.total_activities == len(rows)
        assert mine.unique_courses_accessed == len({r["course"] for r in rows})
        watched = sum(r["watch_seconds"] for r in rows if r["kind"] == "video_completed")
        assert mine.total_watch_seconds == watched
        scores = [r["score"] for r in rows if r["kind"] == "quiz_submitted"]
        assert mine.avg_quiz_score == (pytest.approx(sum(scores) / len(scores)) if scores else None)


def test_rankings(bronze, drawn):
    watched, enrolled = Counter(), Counter()
    for row in drawn:
        if row["kind"] == "video_completed":
            watched[row["video_id"]] += row["watch_seconds"]
        if row["kind"] == "course_enrolled":
            enrolled[row["course"]] += 1
    videos = [(r.video_id, r.total_watch_seconds) for r in ct.most_watched_videos(bronze).collect()]
    assert videos == sorted(watched.items(), key=lambda item: (-item[1], item[0]))
    courses = [(r.course_id, r["count"]) for r in ct.top_courses(bronze, k=5).collect()]
    assert courses == sorted(enrolled.items(), key=lambda item: (-item[1], item[0]))[:5]


def test_health_and_completion(bronze, drawn):
    health = ct.pipeline_health(bronze, ct.user_progress(bronze, DAY)).first()
    users = {row["user"] for row in drawn}
    assert (health.bronze_records, health.silver_records) == (len(drawn), len(users))
    assert (health.active_users, health.active_courses) == (len(users), len({r["course"] for r in drawn}))
    assert health.status == "HEALTHY"
    submitted = [r for r in drawn if r["kind"] == "quiz_submitted" and r["course"] == "c3"]
    counts = {r.definition: r.users for r in ct.course_completion(bronze, "c3", DAY).collect()}
    assert counts == {
        "strict_passed": len({r["user"] for r in submitted if r["passed"]}),
        "loose_any_quiz": len({r["user"] for r in submitted}),
    }


def test_shares_sum_to_all(bronze):
    shares = ct.engagement_distribution(ct.user_progress(bronze, DAY)).collect()
    assert sum(r.percentage for r in shares) == pytest.approx(100, abs=0.15)
