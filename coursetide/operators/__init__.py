from .bronze import decode_records, field_of_rest, parse_events
from .distincts import COUNTED, day_bitmaps, distinct_by_day, distinct_counts
from .health import (
    freshness,
    missing_event_types,
    offset_gaps,
    pipeline_health,
    require_no_gaps,
    table_profile,
)
from .kpis import (
    avg_quiz_score_per_course,
    completed_users,
    course_completion,
    engagement_distribution,
    events_by_type,
    most_watched_videos,
    silver_kpis,
    top_courses,
)
from .silver import user_progress, user_progress_between, user_progress_on
from .sketches import day_sketches, merge_sketches, profile_of
from .states import (
    avg_quiz_score_per_course_of,
    bronze_states,
    day_states,
    engagement_distribution_of,
    events_by_type_of,
    merge_states,
    most_watched_videos_of,
    pipeline_health_of,
    silver_kpis_of,
    silver_states,
    top_courses_of,
)

__all__ = [
    "COUNTED",
    "avg_quiz_score_per_course",
    "avg_quiz_score_per_course_of",
    "bronze_states",
    "completed_users",
    "course_completion",
    "day_bitmaps",
    "day_sketches",
    "day_states",
    "decode_records",
    "distinct_by_day",
    "distinct_counts",
    "engagement_distribution",
    "engagement_distribution_of",
    "events_by_type",
    "events_by_type_of",
    "field_of_rest",
    "freshness",
    "merge_sketches",
    "merge_states",
    "missing_event_types",
    "most_watched_videos",
    "most_watched_videos_of",
    "offset_gaps",
    "parse_events",
    "pipeline_health",
    "pipeline_health_of",
    "profile_of",
    "require_no_gaps",
    "silver_kpis",
    "silver_kpis_of",
    "silver_states",
    "table_profile",
    "top_courses",
    "top_courses_of",
    "user_progress",
    "user_progress_between",
    "user_progress_on",
]
