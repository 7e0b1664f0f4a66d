"""Dedupe against all landed ids, physical placement, and state read back from a checkpoint."""

import random
import re

import pytest
from pyspark.sql import functions as F

from orderpulse.functions.partitioning import placed
from orderpulse.schemas import EVENT_SCHEMA
from orderpulse.session import scratch_path
from orderpulse.sinks.raw import read_raw
from orderpulse.sinks.seen import SeenIds, bloom_places, has_bit
from orderpulse.streaming import land_merge as P
from orderpulse.streaming import progress
from orderpulse.streaming.sources import file_messages
from test_streaming import E1, E2, E3, publish


def rows(spark, ids):
    return spark.createDataFrame([(i, 1, 1, "PAID", None, "t") for i in ids], EVENT_SCHEMA)


def test_unseen_rows_are_exact(spark):
    rng = random.Random(8)
    seen, known = SeenIds(spark, scratch_path(spark, "test_seen")), set()
    for b in range(5):
        ids = [f"id-{rng.randint(0, 120)}" for _ in range(60)] + [None, None]
        got = [r.event_id for r in seen.unseen(rows(spark, ids), b).collect()]
        assert sorted(got, key=str) == sorted([*({i for i in ids if i} - known), None, None], key=str)
        # a batch that is landed again is held against the batches before it alone
        seen.add(rows(spark, [i for i in ids if i]), b)
        again = [r.event_id for r in seen.unseen(rows(spark, ids), b).collect()]
        assert sorted(again, key=str) == sorted(got, key=str)
        known |= {i for i in ids if i}
        if b == 2:
            seen.fold(1)
    assert seen.parts() == ["upto=1", "batch_id=2", "batch_id=3", "batch_id=4"]
    assert seen.unseen(rows(spark, list(known)), 9).count() == 0


def test_filters_leave_parts_out(spark):
    seen = SeenIds(spark, scratch_path(spark, "test_seen"))
    seen.add(rows(spark, [f"a{i:05d}" for i in range(3000)]), 0)
    seen.add(rows(spark, [f"m{i:05d}" for i in range(3000)]), 1)
    new = rows(spark, [f"m{i:05d}x" for i in range(2000)] + ["m00007"]).select("event_id")
    assert seen.candidates(new, "batch_id=0") is None  # another range: neither filter nor ids are read
    maybe = seen.candidates(new, "batch_id=1")
    assert {"m00007"} <= {r.event_id for r in maybe.collect()} and maybe.count() < 100
    assert not any("/ids/" in re.sub(r"/[^/]*$", "", f) for f in maybe.inputFiles() if "batch_id=1" in f)


def test_bits_of_a_bitmap(spark):
    ids = spark.createDataFrame([(f"x{i}",) for i in range(50)], "event_id string")
    places = bloom_places(ids, 2)
    bitmaps = places.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    assert places.join(bitmaps, "bucket").where(~has_bit("bitmap", "bit")).count() == 0
    empty = bitmaps.crossJoin(spark.range(32768).select(F.col("id").alias("bit")))
    assert empty.where(has_bit("bitmap", "bit")).count() == places.select("bucket", "bit").distinct().count()


def test_a_redelivery_of_any_age_is_dropped(spark):
    root = scratch_path(spark, "test_history")
    paths, landing = P.PipelinePaths(root), f"{root}/landing"
    for wave in ([E1, E1, E2], [E3, "bad"], [E1, E2, "bad"], [E3]):
        publish(spark, landing, wave)
        P.run_to_completion(P.start_raw_landing(file_messages(spark, landing), paths, trigger="drain", dedupe="history"))
    assert sorted(r.event_id for r in read_raw(spark, paths.raw).collect()) == ["e1", "e2", "e3"]
    assert [(n.batch_id, n.good, n.bad) for n in paths.log(spark).after(-1)] == [(0, 2, 0), (1, 1, 1), (2, 0, 1)]
    assert P.quarantined(spark, paths).count() == 2


@pytest.mark.parametrize("available", [[0], [1, 4, 6]])
def test_placed_rows_lie_where_they_are_told(spark, available):
    df = spark.range(200).withColumn("partition", F.element_at(F.array(*map(F.lit, available)), (F.col("id") % len(available) + 1).cast("int")))
    out = placed(df, "partition", available)
    assert out.where(F.spark_partition_id() != F.col("partition")).count() == 0 and out.count() == 200
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def test_state_of_a_query_is_read_from_its_checkpoint(spark):
    from orderpulse.streaming.stateful import start_stateful_merge

    root = scratch_path(spark, "test_state")
    paths, landing = P.PipelinePaths(root), f"{root}/landing"
    publish(spark, landing, [E1, E2, E3, E1])
    P.run_to_completion(P.start_raw_landing(file_messages(spark, landing), paths, trigger="drain"))
    P.run_to_completion(start_stateful_merge(spark, paths, trigger="drain"))
    checkpoint = f"{root}/_checkpoint/stateful"
    (op,) = progress.state_summary(spark, checkpoint).collect()
    assert (op.operator_name, op.state_rows) == ("stateStoreSave", 3)
    assert sorted(r.key.order_id for r in progress.state_rows(spark, checkpoint).collect()) == [1, 2, 3]
