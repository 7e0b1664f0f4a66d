"""Measure hot-key skew: share of shuffle records read by the busiest task, per operator.

python tools_skew.py [sf_dir]   -> writes SKEW.md

A third of all events are remapped to one order (derived from the driver's events
table). Each operator runs under its own job description with Spark's event log
written to a fresh scratch folder; the log's task-end records give, for the
operator's largest shuffle stage, the share of records its busiest task read.
A plain ``lag`` window is the contrast.
"""

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from orderpulse.operators.latest import latest_status  # noqa: E402
from orderpulse.operators.sequence import with_previous, with_previous_window  # noqa: E402
from orderpulse.plans.replay import TWO_BATCHES, replay_fold  # noqa: E402
from orderpulse.session import get_spark  # noqa: E402
from orderpulse.sources.fixtures import fx_events  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    run_dir = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    log_dir = f"{run_dir}/eventlog"
    os.makedirs(log_dir)
    spark = get_spark("local[8]", shuffle_partitions=8, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                         "spark.eventLog.rolling.enabled": "false",
                                         "spark.eventLog.compress": "false",
                                         "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    sc = spark.sparkContext
    hot = F.when(F.xxhash64("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("order_id"))
    # Materialize the skewed input as 8 files so every shuffle measured below is the operator's own.
    fx_events(spark, sf_dir).withColumn("order_id", hot).repartition(8).write.parquet(f"{run_dir}/input")
    ev = spark.read.parquet(f"{run_dir}/input")
    seq = ev.select("order_id", "status_ts", "event_id", "new_status")
    ops = {
        "latest (max struct)": lambda: latest_status(ev),
        "latest (row_number + group limit)": lambda: latest_status(ev, "window"),
        "replay fold": lambda: replay_fold(ev, TWO_BATCHES),
        "previous row, skew-safe": lambda: with_previous(seq, "order_id", ["status_ts", "event_id"], ["new_status"]),
        "previous row, plain lag window (contrast)":
            lambda: with_previous_window(seq, "order_id", ["status_ts", "event_id"], ["new_status"]),
    }
    hot_rows = ev.where(F.col("order_id") == 0).count()
    total_rows = ev.count()
    for name, build in ops.items():
        sc.setJobDescription(name)
        build().write.format("noop").mode("overwrite").save()
    sc.setJobDescription(None)
    spark.stop()

    stage_op, per_op = {}, defaultdict(list)
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as f:
            for line in f:
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart":
                    desc = (e.get("Properties") or {}).get("spark.job.description")
                    for sid in e.get("Stage IDs", []):
                        stage_op[sid] = desc
                elif e["Event"] == "SparkListenerTaskEnd":
                    m = e.get("Task Metrics") or {}
                    read = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    per_op[e["Stage ID"]].append(read)
    worst = {}
    for sid, reads in per_op.items():
        op = stage_op.get(sid)
        if op in ops and sum(reads):
            share = max(reads) / sum(reads)
            if op not in worst or sum(reads) > worst[op][2]:  # the operator's largest shuffle
                worst[op] = (share, max(reads), sum(reads), len(reads))
    out = ["# Hot-key skew (measured)\n",
           f"Input: `{sf_dir}` events, {total_rows} rows; one order holds {hot_rows} of them "
           f"({hot_rows / total_rows:.0%}), stored as 8 files. local[8], 8 shuffle partitions, "
           "partition coalescing off.\n",
           "For each operator, its largest shuffle stage and the share of that stage's records read by "
           "its busiest task (balanced is 1/8 = 12.5%). Generated by `python tools_skew.py` from "
           "Spark's event log.\n",
           "| operator | largest stage: busiest task reads | stage reads | tasks | busiest share |",
           "|---|---|---|---|---|"]
    for op in ops:
        if op in worst:
            share, mx, tot, n = worst[op]
            out.append(f"| {op} | {mx} | {tot} | {n} | {share:.1%} |")
        else:
            out.append(f"| {op} | - | - | - | - |")
    with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), "SKEW.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    print("\n".join(out))


if __name__ == "__main__":
    main()
