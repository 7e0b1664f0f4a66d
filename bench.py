"""Time the headline queries: prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is timed end to end -- building the DataFrame plus running it into
the ``noop`` sink (no driver collect). All queries are warmed up once, then
BENCH_REPEAT interleaved rounds are timed; the best round per query is reported.
``exec_only`` additionally times the execution of an already-built DataFrame for
the batch queries (streaming entries run their stream while being built, so they
have end-to-end numbers only).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderpulse.plans.catalogue import QUERIES  # noqa: E402
from orderpulse.session import get_spark  # noqa: E402

HEADLINE = [
    "latest_status",
    "latest_status_window",
    "merge_two_batches",
    "merge_five_batches_incremental",
    "validate_counts",
    "latest_mismatch",
    "dashboard_metrics",
    "status_transitions",
    "enrich_price",
    "partition_by_customer",
    "json_round_trip",
    "stream_land_merge",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = sys.argv[1:] or HEADLINE
    # local mode runs every task in the driver JVM: give it a heap that fits the run
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})

    def run(name: str) -> tuple[float, float]:
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        t1 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        t2 = time.perf_counter()
        return t2 - t0, t2 - t1

    best = {name: run(name) for name in names}  # warm-up round
    for _ in range(repeat):
        for name in names:
            total, exe = run(name)
            best[name] = (min(best[name][0], total), min(best[name][1], exe))
    times = {name: round(best[name][0], 3) for name in names}
    exec_only = {name: round(best[name][1], 3) for name in names if not name.startswith("stream")}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": cpus, "exec_only": exec_only}))
    spark.stop()


if __name__ == "__main__":
    main()
