"""Measure per-task shuffle input of the cluster count under a hot key.

Runs in its own session with the event log written to a scratch folder, then reads the
task metrics back. Prints one JSON line: the largest number of shuffle records any task
read, for the salted join-back and for a window count (the form it replaces).
Usage: python tools/skew_probe.py ROWS HOT_FRACTION ROWS_PER_TASK
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)


def max_task_records(log_dir: str, job_group: str) -> int:
    best = 0
    stage_group: dict[int, str] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or "appstatus" in os.path.basename(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerStageSubmitted":
                    props = ev.get("Properties") or {}
                    stage_group[ev["Stage Info"]["Stage ID"]] = props.get("spark.jobGroup.id", "")
                elif kind == "SparkListenerTaskEnd" and stage_group.get(ev["Stage ID"]) == job_group:
                    metrics = ev.get("Task Metrics") or {}
                    best = max(best, metrics.get("Shuffle Read Metrics", {}).get("Total Records Read", 0))
    return best


def main() -> None:
    rows, hot_fraction, per_task = int(sys.argv[1]), float(sys.argv[2]), int(sys.argv[3])
    from pyspark.sql import SparkSession, Window
    from pyspark.sql import functions as F

    log_dir = tempfile.mkdtemp(prefix="formlake-eventlog-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.dir", log_dir)
        .config("spark.sql.shuffle.partitions", "64")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        # measure the shuffle path itself: no size-based broadcast by Spark either
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.skewJoin.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from formlake.operators.joins import attach_group_count

    hot_every = int(round(1 / hot_fraction))
    df = spark.range(rows).select(
        F.when(F.col("id") % hot_every == 0, F.lit("HOT")).otherwise(F.concat(F.lit("T"), (F.col("id") % 5000).cast("string"))).alias("ticker"),
        F.lit("2026-01-05").cast("date").alias("filing_date"),
        F.col("id").alias("v"),
    )
    sc = spark.sparkContext
    sc.setJobGroup("salted", "salted join-back")
    salted = attach_group_count(df, ["ticker", "filing_date"], "n", max_broadcast_rows=100, task_rows=per_task)
    salted.write.format("noop").mode("overwrite").save()
    sc.setJobGroup("window", "window count")
    w = df.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("ticker", "filing_date")))
    w.write.format("noop").mode("overwrite").save()
    hot_rows = df.filter(F.col("ticker") == "HOT").count()
    spark.stop()
    print(json.dumps({
        "rows": rows, "hot_rows": hot_rows, "rows_per_task": per_task,
        "max_task_records_salted": max_task_records(log_dir, "salted"),
        "max_task_records_window": max_task_records(log_dir, "window"),
    }))


if __name__ == "__main__":
    main()
