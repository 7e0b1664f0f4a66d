"""Write PLANS.md: the executed (final, after AQE) physical plans of the key operators.

python tools_plans.py [sf_dir]
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderpulse.operators.upsert import latest_source, merge_latest  # noqa: E402
from orderpulse.plans.catalogue import QUERIES, TWO_BATCHES, run_stream_waves  # noqa: E402
from orderpulse.session import get_spark  # noqa: E402
from orderpulse.sources.fixtures import fx_events  # noqa: E402

NOTES = {
    "latest_status": "partial max(struct) before the exchange; pruned ReadSchema",
    "latest_status_window": "partial WindowGroupLimit before the exchange",
    "merge_two_batches_fold": "one scan, one exchange, then the fold",
    "state_merge": "the touched buckets of the state joined with the reduced batch",
    "orphan_orders": "anti join",
    "enrich_price": "broadcast behind a measured size bound",
    "dashboard_metrics": "each source aggregated once, one-row results stacked",
    "status_transitions": "range partitions + boundary carry from Arrow batches (checkpointed input)",
    "recent_status_top1000": "TakeOrderedAndProject",
}


def final_plan(df) -> str:
    df.collect()  # runs the frame's own query execution, so the adaptive plan is final
    text = df._jdf.queryExecution().executedPlan().toString()
    text = re.sub(r"#\d+L?", "", text)
    text = re.sub(r"\[plan_id=\d+\]", "", text)
    text = re.sub(r"file:/\S+?/(\w+\.parquet|state/v=\d+)", r"\1", text)
    return "\n".join(line[:180] for line in text.splitlines())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=8)
    out = [f"# Executed plans ({sf_dir}, local[8], AQE on)\n",
           "Generated by `python tools_plans.py`. Expression ids and local paths are stripped.\n"]
    for name, note in NOTES.items():
        if name == "state_merge":
            store = run_stream_waves(spark, sf_dir, TWO_BATCHES)
            c = store.latest_commit()
            source = latest_source(fx_events(spark, sf_dir).where("batch_id = 3"))
            df = merge_latest(store.read_state(commit=c, only=store.touched(source, c)), source, True)
        else:
            df = QUERIES[name](spark, sf_dir)
        out.append(f"## {name}\n\n{note}\n\n```\n{final_plan(df)}\n```\n")
    with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
