from .aggregates import average_for, distinct_with_null, event_count, total_for
from .scalars import completion_percent, engagement_level, event_day, event_instant, mean_of, percent_of

__all__ = [
    "average_for",
    "completion_percent",
    "distinct_with_null",
    "engagement_level",
    "event_count",
    "event_day",
    "event_instant",
    "mean_of",
    "percent_of",
    "total_for",
]
