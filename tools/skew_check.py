"""Measure how a hot visitor spreads over tasks.

Builds a skewed event set from ``events`` (copies shifted in time; one
visitor takes a third of the rows), cuts sessions with both strategies and
with a naive ``Window.partitionBy(visitor)`` plan, and reads Spark's event
log (written to a fresh scratch folder) to report, per plan, the largest
share of shuffle records read by a single task in any stage.

    python tools/skew_check.py [sf_dir] [copies]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from weft.operators.sessions import SessionSpec, cut_sessions  # noqa: E402


def skewed_events(spark, sf_dir: str, copies: int):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    n = ev.agg(F.max("event_id")).first()[0] + 1
    x = ev.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return x.select(
        (F.col("event_id") + F.col("rep") * n).alias("event_id"),
        (F.col("ts") + F.make_dt_interval(F.col("rep") * 31)).alias("ts"),
        # one visitor takes every third event
        F.when(F.pmod(F.col("event_id"), F.lit(3)) == 0, F.lit(-1)).otherwise(F.col("user_id")).alias("user_id"),
        "event_type", "value")


def naive_window(df, spec):
    w = Window.partitionBy(spec.user).orderBy(spec.ts, spec.order)
    x = df.filter(F.col(spec.kind).isin(spec.pageview, spec.click))
    prev = F.lag(spec.ts).over(w)
    x = x.withColumn("_n", F.when(prev.isNull() | (F.col(spec.ts) - prev > F.expr("INTERVAL 30 MINUTES")), 1)
                     .otherwise(0))
    x = x.withColumn("_s", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return x.groupBy(spec.user, "_s").agg(F.count(F.lit(1)).alias("n"))


def stage_skew(log_dir: str, jobs: tuple[int, int], min_records: int, verbose: bool = False) -> float:
    """Largest per-task share of shuffle records read within a stage, over
    stages that read at least ``min_records`` (small bookkeeping stages that
    AQE folds into one task are not skew)."""
    per_stage: dict[int, list[int]] = {}
    stage_job: dict[int, int] = {}
    stage_info: dict[int, tuple[str, float]] = {}
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart":
                    for s in e.get("Stage IDs", []):
                        stage_job[s] = e["Job ID"]
                if e["Event"] == "SparkListenerStageCompleted":
                    si = e["Stage Info"]
                    dur = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
                    stage_info[si["Stage ID"]] = (si["Stage Name"][:60], dur)
                if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                    r = e["Task Metrics"].get("Shuffle Read Metrics", {})
                    recs = r.get("Total Records Read", 0)
                    per_stage.setdefault(e["Stage ID"], []).append(recs)
    worst = 0.0
    for sid, recs in per_stage.items():
        if not (jobs[0] <= stage_job.get(sid, -1) < jobs[1]):
            continue
        if verbose:
            print("   stage", sid, stage_info.get(sid), "tasks", len(recs), "records", sum(recs), "max", max(recs))
        if sum(recs) < min_records:
            continue
        worst = max(worst, max(recs) / sum(recs))
    return worst


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 and sys.argv[2].isdigit() else 10
    logs = tempfile.mkdtemp(prefix="weft-eventlog-")
    spark = (SparkSession.builder.master("local[8]").appName("weft-skew")
             .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "32")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logs)
             .config("spark.eventLog.compress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    df = skewed_events(spark, sf_dir, copies)
    total = df.count()
    hot = df.filter(F.col("user_id") == -1).count()
    spec = SessionSpec("user_id", "ts", "event_id", "event_type", pageview="view", click="click")
    plans = {"gap (cells)": lambda: cut_sessions(df, spec, "gap"),
             "pageview (segments)": lambda: cut_sessions(df, spec, "pageview"),
             "naive Window.partitionBy(user)": lambda: naive_window(df, spec)}
    out = {"rows": total, "hot_visitor_rows": hot}
    sc = spark.sparkContext
    ranges = {}
    for name, build in plans.items():
        sc.setJobGroup(name, name)
        t0 = time.time()
        build().write.format("noop").mode("overwrite").save()
        ids = sc.statusTracker().getJobIdsForGroup(name)
        ranges[name] = (min(ids), max(ids) + 1)
        out[name] = {"sec": round(time.time() - t0, 2)}
    spark.stop()
    for name in plans:
        if "-v" in sys.argv:
            print(name)
        out[name]["max_task_share"] = round(
            stage_skew(logs, ranges[name], total // 20, "-v" in sys.argv), 3)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
