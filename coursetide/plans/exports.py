"""The business KPIs as CSV extracts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from ..operators import avg_quiz_score_per_course, course_completion, most_watched_videos
from ..session import as_day, yesterday_utc
from ..sources import append_extract


def export_kpis(
    bronze: DataFrame,
    root: str,
    course_id: str,
    metric_date: date | str | None = None,
    files: int | None = None,
) -> None:
    """Append the three extracts under ``root``, for yesterday unless a day is given.

    Full rankings are written, not only their heads.
    """
    day = yesterday_utc() if metric_date is None else as_day(metric_date)
    append_extract(
        avg_quiz_score_per_course(bronze), f"{root}/avg_quiz_score_per_course", day, files=files
    )
    append_extract(most_watched_videos(bronze), f"{root}/most_watched_videos", day, files=files)
    append_extract(
        course_completion(bronze, course_id, day),
        f"{root}/course_completion",
        day,
        keys=["course_id"],
        files=files,
    )
