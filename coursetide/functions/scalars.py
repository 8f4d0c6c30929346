"""Scalar column expressions. All null-on-error, also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fewest activities a day for the two upper engagement levels.
HIGH_ENGAGEMENT = 5
MEDIUM_ENGAGEMENT = 2


def event_instant(iso: Column) -> Column:
    """ISO-8601 text to a timestamp; null where the text is no timestamp."""
    return F.try_to_timestamp(iso)


def event_day(instant: Column) -> Column:
    """UTC calendar day of an instant (the session zone is UTC)."""
    return F.to_date(instant)


def completion_percent(finished: Column, opened: Column) -> Column:
    """Finished as a percentage of finished *plus* opened; null when both are zero."""
    return F.try_divide(finished, (opened + finished).cast("double")) * 100.0


def mean_of(left: Column, right: Column) -> Column:
    """Mean of two columns; null when either is null."""
    return (left + right) / 2.0


def engagement_level(activities: Column) -> Column:
    upper = F.when(activities >= HIGH_ENGAGEMENT, "High").when(activities >= MEDIUM_ENGAGEMENT, "Medium")
    return upper.otherwise("Low")


def percent_of(part: Column, whole: Column, digits: int) -> Column:
    return F.round(F.try_divide(part, whole) * 100, digits)
