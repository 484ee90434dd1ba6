"""Measure task skew of the sequence features on a lap table with one hot key.

One (year, circuit, driver) key is given a third of all laps (the rest keep their own
keys). The sequence features and the hot-key joins run on it; Spark's event log (written
to a fresh scratch folder) gives, per operator, the largest share of shuffle-read records
that any single task handled.

Usage: python tools/skew_probe.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(sf_dir: str) -> None:
    from pyspark.sql import SparkSession, functions as F
    from lapstats import testview
    from lapstats.operators import clean, panel
    from lapstats.operators.model import linear_degradation, linear_predict
    from lapstats.plans.state import assess_incidents
    from lapstats.session import local_scratch

    logdir = tempfile.mkdtemp(prefix="lapstats-eventlog-")
    spark = (SparkSession.builder.master("local[8]").appName("skew-probe")
             .config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", logdir).config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             # AQE's skew-join split, scaled down so that it triggers at test size
             .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "256k")
             .config("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
             .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    local_scratch(spark)
    laps = testview.laps(spark, sf_dir)
    hot = (F.col("lap_id") % 3) == 0
    skewed = laps.select(
        "lap_id", F.when(hot, F.lit(2021)).otherwise(F.col("year")).alias("year"),
        F.when(hot, F.lit("monza")).otherwise(F.col("circuit")).alias("circuit"),
        F.when(hot, F.lit("HOT")).otherwise(F.col("driver")).alias("driver"),
        F.when(hot, F.col("lap_id").cast("int")).otherwise(F.col("lap_number")).alias("lap_number"),
        "lap_time", "compound", "stint", "tyre_life", "track_status", "position", "gap_to_leader")
    base = clean.normalise_columns(clean.remove_invalid_laps(skewed)).checkpoint()
    plans = skewed.select("year", "circuit", "lap_id", F.array("lap_number").alias("pit_laps"))
    results = {}
    pits = panel.detect_pit_stops(skewed)
    jobs = {
        "engineer_features": lambda: panel.engineer_features(base, None),
        "relative_performance": lambda: panel.relative_performance(skewed),
        "states": lambda: testview.states(skewed),
        "incident_join": lambda: assess_incidents(plans, testview.incidents(skewed)),
        "linear_predict": lambda: linear_predict(skewed, linear_degradation(skewed)),
        "iqr_by_circuit": lambda: clean.iqr_filter(skewed, by=["circuit"]),
        "laps_since_pit": lambda: panel.laps_since_pit(skewed, pits),
    }
    for mode, make in jobs.items():
        spark.sparkContext.setJobGroup(mode, mode)
        t = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        results[mode] = {"sec": round(time.perf_counter() - t, 2)}
    spark.stop()

    # per job group: the largest fraction of a stage's shuffle-read records in one task
    stage_group, tasks = {}, {}
    for path in glob.glob(os.path.join(logdir, "**", "*"), recursive=True):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(raw).read()
        for line in raw.decode("utf-8").splitlines():
            if line.strip():
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerStageSubmitted":
                    props = ev.get("Properties") or {}
                    stage_group[ev["Stage Info"]["Stage ID"]] = props.get("spark.jobGroup.id")
                elif kind == "SparkListenerTaskEnd" and ev.get("Task Metrics"):
                    rd = ev["Task Metrics"].get("Shuffle Read Metrics", {})
                    recs = rd.get("Total Records Read", 0)
                    tasks.setdefault(ev["Stage ID"], []).append(recs)
    # multi-task stages only: single-task stages are global aggregates by design
    for mode in results:
        worst, where = 0.0, None
        for sid, recs in tasks.items():
            if stage_group.get(sid) == mode and len(recs) >= 4 and sum(recs) > 1000:
                share = max(recs) / sum(recs)
                if share > worst:
                    worst, where = share, (sid, max(recs), sum(recs), len(recs))
        results[mode]["max_task_share_of_stage_records"] = round(worst, 3)
        results[mode]["worst_stage"] = where
    print(json.dumps(results))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
