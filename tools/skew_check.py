"""Skew check: one key holds a third of all rows; measure what reaches each reduce task.

Derives a skewed copy of ``events`` (a third of the rows moved to one instant /
one city / one series) and runs the operators whose grouping could be hot. For
each, reports the largest and the median number of records read by a task
after a shuffle, from Spark's event log. Usage::

    python tools/skew_check.py [--sf-dir /root/testdata/sf0.1] [--parts 16]
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _records_read(log_dir: str) -> dict[tuple[str, int], list[int]]:
    """Per (job group, stage): shuffle records read by each task of reduce stages."""
    files = sorted(p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
                   if os.path.isfile(p) and "appstatus" not in p)
    stage_group: dict[int, str] = {}
    out: dict[tuple[str, int], list[int]] = {}
    for path in files:
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    n = m.get("Total Records Read", 0)
                    if n:
                        sid = ev["Stage ID"]
                        out.setdefault((stage_group.get(sid, ""), sid), []).append(n)
    return out


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--parts", type=int, default=16)
    args = ap.parse_args()
    log_dir = tempfile.mkdtemp(prefix="tempora-skew-")

    from pyspark.sql import functions as F

    from tempora.operators.aggregates import group_averages, mode_per_group
    from tempora.operators.series import previous_row
    from tempora.plans.weather_price import bucketed_readings
    from tempora.session import get_session, shared_path
    from tempora.sources.sinks import KeyedTable

    spark = get_session("local[8]", shuffle_partitions=args.parts, extra_conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false",
        "spark.driver.memory": "8g",
        # One task per shuffle partition, so the per-task numbers show the key distribution.
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    ev = spark.read.parquet(f"{args.sf_dir}/events.parquet").repartition(args.parts)
    hot = F.col("event_id") % 3 == 0
    skewed = ev.select(
        F.when(hot, F.lit(1_704_067_200)).otherwise(F.unix_seconds(F.col("ts").cast("timestamp"))).alias("dt"),
        F.when(hot, F.lit(0)).otherwise(F.col("user_id")).alias("user_id"),
        "event_id", "event_type", "value",
    )
    n_rows = skewed.count()

    def run(name, df):
        spark.sparkContext.setJobGroup(name, name)
        df.write.format("noop").mode("overwrite").save()

    b = bucketed_readings(skewed.drop("event_id"), width_seconds=300, dedup=True)
    run("bucket averages (hot bucket)", group_averages(b, "dt", {"avg_value": "value"}))
    run("mode per bucket (hot bucket)", mode_per_group(b, "dt", "event_type", "m"))
    table = KeyedTable(shared_path(spark, "skew_table", unique=True), keys=["user_id"], order=["dt", "event_id"])
    spark.sparkContext.setJobGroup("keyed upsert (hot key)", "keyed upsert (hot key)")
    table.write_batch(skewed.select("user_id", "dt", "event_id", "value"), 0)
    series = skewed.select(F.lit("one").alias("s"), F.timestamp_seconds("dt").cast("timestamp_ntz").alias("t"),
                           "event_id", "value")
    run("previous row, range chunks (hot instant)",
        previous_row(series, ["s"], ["t", "event_id"], ["value"], chunking="range", num_chunks=args.parts))
    run("previous row, one window per series",
        previous_row(series, ["s"], ["t", "event_id"], ["value"], chunk_seconds=None))
    spark.stop()

    print(f"rows {n_rows}, hot key rows {n_rows // 3}, shuffle partitions {args.parts}")
    for (group, sid), reads in sorted(_records_read(log_dir).items(), key=lambda kv: kv[0][1]):
        if group:
            print(f"{group:42s} stage {sid:3d}  max task {max(reads):7d}  median {int(statistics.median(reads)):7d}  "
                  f"tasks {len(reads)}")


if __name__ == "__main__":
    main()
