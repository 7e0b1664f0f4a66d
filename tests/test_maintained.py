"""Views, summaries and matrices that are kept up to date: equal to a rescan, and without one."""

import random
import re

import pytest
from pyspark.sql import functions as F

from orderpulse.operators import reconcile as R
from orderpulse.operators import validate as V
from orderpulse.operators.monitor import event_stats, recent_status
from orderpulse.schemas import EVENT_SCHEMA, STATUS_SCHEMA
from orderpulse.session import scratch_path
from orderpulse.sinks.maintained import RecentHeads, StatusDistribution
from orderpulse.sinks.raw import land_batch, read_batch
from orderpulse.sinks.snapshot import KEEP, SnapshotStore
from orderpulse.sinks.summaries import BatchSummaries
from orderpulse.sinks.transitions import TransitionMatrix, spliced_pairs
from orderpulse.streaming import land_merge as P

STATUSES = ["CREATED", "PAID", "PACKED", None]


def random_events(seed, n, orders=6, hot=None):
    import datetime as dt

    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    return [(f"e{i:04d}", hot if hot is not None and rng.random() < 0.5 else rng.randint(1, orders), 1, rng.choice(STATUSES),
             None if rng.random() < 0.1 else start + dt.timedelta(hours=rng.randint(0, 60)), "t") for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def folders(df):
    """Folders that a frame's files lie in."""
    return {re.sub(r"/[^/]*$", "", f) for f in df.inputFiles()}


def same(a, b):
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


@pytest.fixture()
def pipeline(spark):
    """A raw folder and a store, and a way to land and merge one more batch."""
    paths = P.PipelinePaths(scratch_path(spark, "test_views"))
    store = SnapshotStore(spark, paths.store, buckets=4)
    store_of = lambda: SnapshotStore(spark, paths.store, buckets=4)
    count = [0]

    def merge(rows):
        land_batch(frame(spark, rows), paths.raw, count[0])
        commit = P.merge_batch(store_of(), read_batch(spark, paths.raw, count[0]), count[0], "test", "incremental", len(rows), 0, None)
        count[0] += 1
        return commit

    return store, merge


def by_day(store):
    return store.read_status().groupBy("current_status", F.to_date("last_update_ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))


def test_distribution_and_heads_follow_the_merges(spark, pipeline):
    store, merge = pipeline
    counts, heads = StatusDistribution(store), RecentHeads(store, rows=3)
    assert counts.advance() is None and counts.read().count() == 0 and heads.read().count() == 0
    for i in range(5):
        merge(random_events(i, 25, orders=30))
        if i == 2:
            continue  # both catch up at the next commit
        counts.advance(), heads.advance()
        same(counts.read(), by_day(store))
        same(counts.by_status(), V.status_distribution(store.read_status()))
        assert heads.read().collect() == recent_status(store.read_status(), 3).collect()
    assert counts.advance() == store.latest_commit().version  # nothing new
    same(counts.read(), by_day(store))


def test_changes_are_the_orders_that_changed(spark, pipeline):
    store, merge = pipeline
    merge([("a", 1, 7, "CREATED", None, "t"), ("b", 2, 7, "PAID", None, "t")])
    assert {(r.order_id, r.action, r.pre_status, r.current_status) for r in store.changes(0).collect()} == {
        (1, "insert", None, "CREATED"), (2, "insert", None, "PAID")}
    merge([("c", 1, 7, "PAID", __import__("datetime").datetime(2024, 1, 1), "t"), ("d", 2, 7, "PAID", None, "t")])
    assert {(r.order_id, r.action, r.pre_status, r.current_status) for r in store.changes(1).collect()} == {(1, "update", "CREATED", "PAID")}


def test_distribution_reads_the_rewritten_buckets_only(spark, pipeline):
    store, merge = pipeline
    merge(random_events(1, 60, orders=40))
    counts = StatusDistribution(store)
    counts.advance()
    commit = merge(random_events(2, 1))
    read = folders(counts.pending(commit, 0))
    assert sum("/state/" in f for f in read) == 1 and all("/state/v=1/" in f for f in read if "/state/" in f)
    assert not any("/raw/" in f for f in read)


def test_distribution_rebuilds_when_the_feed_is_gone(spark, pipeline):
    store, merge = pipeline
    counts = StatusDistribution(store)
    merge(random_events(0, 10))
    counts.advance()
    for i in range(KEEP + 1):
        commit = merge(random_events(i + 1, 2))
    assert all("/distribution/" not in f for f in folders(counts.pending(commit, 0)))
    counts.advance()
    same(counts.read(), by_day(store))


def test_a_view_that_broke_off_is_written_again(spark, pipeline):
    store, merge = pipeline
    merge(random_events(0, 20))
    counts = StatusDistribution(store)
    spark.createDataFrame([("BROKEN", None, 99)], counts.schema).write.parquet(counts.path(0))
    __import__("os").remove(f"{counts.path(0)}/_SUCCESS")
    assert counts.version() is None
    counts.advance()
    same(counts.read(), by_day(store))


def test_summaries_equal_a_rescan(spark):
    ids = [None, 0, -1, -32768, -32769, 1, 32768, 32769, 2**31, 2**31 + 1, 2**62, -2**62]
    rng = random.Random(3)
    batches = [[(f"{b}-{i}", rng.choice(ids), 1, "PAID", None, "t") for i in range(8)] for b in range(5)]
    out = BatchSummaries(spark, scratch_path(spark, "test_summaries"))
    assert [tuple(r) for r in out.event_stats().collect()] == [(0, 0, None)]
    for b, rows in enumerate(batches):
        out.add(frame(spark, rows), b)
        same(out.event_stats(), event_stats(frame(spark, sum(batches[:b + 1], []))))
    out.add(frame(spark, batches[3]), 3)  # landed again
    out.fold(2)
    assert out.parts() == ["upto=2", "batch_id=3", "batch_id=4"]
    out.add(frame(spark, batches[4]), 4)
    same(out.event_stats(), event_stats(frame(spark, sum(batches, []))))
    assert all("/ids/" in f or "/stats/" in f for f in folders(out.ids()) | folders(out.stats()))


@pytest.mark.parametrize("hot", [None, 3])
def test_spliced_transitions_equal_a_rescan(spark, hot):
    events = random_events(11, 90, hot=hot)
    rng = random.Random(5)
    cuts = [rng.randint(0, 3) for _ in events]
    out = TransitionMatrix(spark, scratch_path(spark, "test_matrix"), buckets=4)
    for b in range(4):
        rows = [e for e, c in zip(events, cuts) if c == b]
        for _ in range(2 if b in (1, 3) else 1):  # some come twice
            out.add(frame(spark, rows), b)
        seen = frame(spark, [e for e, c in zip(events, cuts) if c <= b])
        same(out.read().select("from_status", "to_status", "n", "transition"), V.status_transitions(seen, skew_safe=False))


def test_splice_retracts_and_adds(spark):
    import datetime as dt

    at = lambda h: dt.datetime(2024, 1, 1, h)
    cols = "order_id bigint, status_ts timestamp_ntz, event_id string, new_status string"
    old = spark.createDataFrame([(1, at(1), "a", "CREATED"), (1, at(5), "b", "DELIVERED"), (2, at(1), "c", "PAID")], cols)
    new = spark.createDataFrame([(1, at(2), "d", "PAID"), (1, at(3), "e", "PACKED"), (2, at(0), "f", "CREATED")], cols)
    got = spliced_pairs(old, new).groupBy("from_status", "to_status").agg(F.sum("n").alias("n")).collect()
    assert {tuple(r) for r in got} == {("CREATED", "DELIVERED", -1), ("CREATED", "PAID", 2), ("PAID", "PACKED", 1), ("PACKED", "DELIVERED", 1)}


def test_matrix_reads_only_the_buckets_of_a_batch(spark):
    out = TransitionMatrix(spark, scratch_path(spark, "test_matrix"), buckets=8)
    out.add(frame(spark, random_events(1, 80, orders=40)), 0)
    one = frame(spark, [("z", 5, 1, "PAID", None, "t")])
    (bucket,) = out.touched(one)
    assert all(f"/history/bucket={bucket}/" in f for f in folders(out.history([bucket], 1)))


def test_reconcile_finds_what_differs_and_only_that(spark):
    import datetime as dt

    rows = [(i, i % 5, None, STATUSES[i % 4], dt.datetime(2024, 1, 1, i % 24)) for i in range(300)]
    other = [r for r in rows if r[0] != 7]
    other[20] = (*other[20][:2], None, "LOST", other[20][4])
    other[40] = (other[40][0], None, *other[40][2:])  # a value against a null
    other[60] = (*other[60][:2], other[60][3], None, other[60][4])  # the same values in other columns
    left, right = spark.createDataFrame(rows, STATUS_SCHEMA), spark.createDataFrame([*other, (999, 1, None, "PAID", None)], STATUS_SCHEMA)
    found = {r.order_id: r.kind for r in R.reconcile(left, right).collect()}
    assert found == {7: "missing", other[20][0]: "changed", other[40][0]: "changed", other[60][0]: "changed", 999: "extra"}
    assert R.reconcile(left, left.repartition(7)).count() == 0
    assert R.reconcile(left, left.limit(0)).count() == 300


def test_reconcile_stores_opens_no_equal_bucket(spark):
    stores = []
    for n in range(2):
        store = SnapshotStore(spark, scratch_path(spark, "test_reconcile"), buckets=8)
        rows = random_events(4, 60, orders=40)
        P.merge_batch(store, frame(spark, rows).withColumn("batch_id", F.lit(0).cast("bigint")), 0, "q", "incremental", 60, 0, None)
        stores.append(store)
    assert R.reconcile_stores(*stores).count() == 0
    late = frame(spark, [("zz", 3, 1, "DELIVERED", __import__("datetime").datetime(2025, 1, 1), "t")]).withColumn("batch_id", F.lit(1).cast("bigint"))
    P.merge_batch(stores[1], late, 1, "q", "incremental", 1, 0, None)
    found = R.reconcile_stores(*stores)
    assert [(r.order_id, r.kind) for r in found.collect()] == [(3, "changed")]
    assert len({f.split("/bucket=")[1] for f in folders(found)}) == 1
