"""Physical-plan properties that matter at scale (checked on the executed plans)."""

import io
import re
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from conftest import SF_SMALL
from orderpulse.operators.enrich import enrich_price
from orderpulse.operators.monitor import filter_status
from orderpulse.plans.catalogue import QUERIES, TWO_BATCHES, run_stream_waves
from orderpulse.session import scratch_path
from orderpulse.sources.fixtures import fx_events, fx_inventory, fx_order_lines


def plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_latest_reduces_before_the_exchange_and_prunes_columns(spark):
    p = plan(QUERIES["latest_status"](spark, SF_SMALL))
    assert "partial_max" in p
    assert p.index("partial_max") > p.index("Exchange")  # formatted plans list children later
    scans = re.findall(r"ReadSchema: (struct<[^>]*>)", p)
    assert scans and all("value" not in s for s in scans)  # the unused events.value column is pruned


def test_window_variant_limits_before_the_exchange(spark):
    p = plan(QUERIES["latest_status_window"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_merge_reads_only_the_touched_buckets(spark):
    from orderpulse.operators.upsert import latest_source

    store = run_stream_waves(spark, SF_SMALL, TWO_BATCHES)
    c = store.latest_commit()
    one = fx_events(spark, SF_SMALL).where("batch_id = 3").limit(1)
    touched = store.touched(latest_source(one), c)
    assert len(touched) == 1
    files = store.read_state(commit=c, only=touched).inputFiles()
    assert files and all(f"/bucket={touched[0]}/" in f for f in files)


def test_orphans_use_an_anti_join(spark):
    p = plan(QUERIES["orphan_orders"](spark, SF_SMALL))
    assert "LeftAnti" in p


def test_broadcast_only_within_the_measured_bound(spark):
    lines, inv = fx_order_lines(spark, SF_SMALL), fx_inventory(spark, SF_SMALL)
    assert "BroadcastHashJoin" in plan(enrich_price(lines, inv, F.col("fallback_price")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(enrich_price(lines, inv, F.col("fallback_price")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["recent_status_top1000"](spark, SF_SMALL))


def test_dashboard_scans_events_once_per_use(spark):
    p = plan(QUERIES["dashboard_metrics"](spark, SF_SMALL))
    # status slice + status count + event stats: three scans of events, no subquery fan-out
    assert len(re.findall(r"(?m)^\(\d+\) Scan parquet", p.split("===== Subqueries")[0])) == 3
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_scans_are_not_redistributed(spark):
    for name in ("latest_status", "validate_counts", "enrich_price", "status_distribution"):
        assert "RoundRobinPartitioning" not in plan(QUERIES[name](spark, SF_SMALL)), name


def test_unconsumed_delta_is_one_pruned_scan(spark):
    p = plan(QUERIES["unconsumed_delta"](spark, SF_SMALL))
    assert len(re.findall(r"(?m)^\(\d+\) Scan parquet", p)) == 1 and "PartitionFilters: [isnotnull(batch_id" in p
    assert "Join" not in p


def test_price_fallback_is_taken_at_every_size(spark):
    from conftest import SF_CHECK

    for sf in (SF_SMALL, SF_CHECK):
        lines, inv = fx_order_lines(spark, sf), fx_inventory(spark, sf)
        missed = lines.join(inv, "product_id", "left_anti").count()
        assert 0 < missed < lines.count() / 4


def test_status_filters_reach_the_scan(spark):
    path = scratch_path(spark, "test_pushdown")
    QUERIES["merge_two_batches_fold"](spark, SF_SMALL).write.parquet(path)
    p = plan(filter_status(spark.read.parquet(path), statuses=["PAID"], since="2024-01-10 00:00:00"))
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", p)
    assert pushed and "current_status" in pushed[0] and "last_update_ts" in pushed[0]


def test_transitions_never_hash_the_events_by_order(spark):
    p = plan(QUERIES["status_transitions"](spark, SF_SMALL))
    main = p.split("===== Subqueries")[0]
    assert "MapInArrow" in main
    assert not re.search(r"hashpartitioning\(order_id#", main)
    assert re.search(r"hashpartitioning\(from_status#\d+L?, to_status#", main)
