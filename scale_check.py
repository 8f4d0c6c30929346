"""Times the operators on a stored bronze table of replicated events with a hot learner.

    python scale_check.py [copies] [cores ...]

Every event is copied ``copies`` times with learners and videos of its own, then a third of
all rows is given to one learner, one course and one video. Prints one JSON line per
number of cores.
"""

from __future__ import annotations

import json
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import coursetide as ct
from coursetide.fixtures import COURSES, as_records, lms_events
from coursetide.session import scratch_dir

SF_DIR = "/root/testdata/sf0.1"
DAY = "2024-01-15"


def session(cores: int) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("coursetide-scale")
        .config("spark.sql.shuffle.partitions", str(4 * cores))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return ct.prepare(spark)


def replicated(spark: SparkSession, copies: int) -> DataFrame:
    events = lms_events(spark, SF_DIR).repartition(spark.sparkContext.defaultParallelism)
    copy = F.col("copy")
    hot = F.pmod(F.xxhash64("event_id", "copy"), F.lit(3)) == 0
    video = F.concat("payload.video_id", F.lit("-"), copy)
    hot_video = F.when(F.col("payload.video_id").isNotNull(), "v-hot")
    return (
        events.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
        .withColumn("event_id", F.concat("event_id", F.lit("-"), copy))
        .withColumn("user_id", F.when(hot, "hot").otherwise(F.concat("user_id", F.lit("-"), copy)))
        .withColumn("course_id", F.when(hot, COURSES[0]).otherwise(F.col("course_id")))
        .withColumn("payload", F.col("payload").withField("video_id", F.when(hot, hot_video).otherwise(video)))
        .drop("copy")
    )


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 2)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 100
    all_cores = [int(cores) for cores in sys.argv[2:]] or [8]
    root = None
    for n, cores in enumerate(all_cores):
        spark = session(cores)
        if n == 0:
            root = scratch_dir(spark, "scale")
            bronze = replicated(spark, copies)
            bronze.repartition("event_date").write.partitionBy("event_date").parquet(f"{root}/bronze")
            as_records(bronze).write.parquet(f"{root}/log")
        bronze = ct.read_bronze(spark, f"{root}/bronze")
        out = f"{root}/{cores}"

        def ingest(gather: bool) -> float:
            raw = ct.replay_records(spark, f"{root}/log")
            to = f"{out}/{gather}"
            return timed(
                lambda: ct.ingest(raw, f"{to}/bronze", f"{to}/cp", catch_up=True, gather_days=gather).awaitTermination()
            )

        times = {
            "ingest": ingest(False),
            "ingest_gathered": ingest(True),
            "user_progress_day": timed(lambda: run(ct.user_progress(bronze, DAY))),
            "user_progress_all": timed(lambda: run(ct.user_progress_between(bronze))),
            "backfill": timed(lambda: ct.backfill(bronze, f"{out}/silver", "2024-01-01", "2024-01-30")),
        }
        silver = ct.read_silver(spark, f"{out}/silver")
        for name, df in {
            "pipeline_health": ct.pipeline_health(bronze, silver),
            "freshness": ct.freshness(bronze, silver),
            "missing_event_types": ct.missing_event_types(bronze),
            "silver_kpis": ct.silver_kpis(silver),
            "engagement_distribution": ct.engagement_distribution(silver),
            "top_courses": ct.top_courses(bronze),
            "events_by_type": ct.events_by_type(bronze),
            "avg_quiz_score_per_course": ct.avg_quiz_score_per_course(bronze),
            "most_watched_videos": ct.most_watched_videos(bronze),
            "course_completion": ct.course_completion(bronze, COURSES[0], DAY),
        }.items():
            times[name] = timed(lambda df=df: run(df))
        rows = {"bronze": bronze.count(), "silver": silver.count()}
        spark.stop()
        print(json.dumps({"cores": cores, "rows": rows, "seconds": times}), flush=True)


if __name__ == "__main__":
    main()
