"""Stalled orders: the stream against the table, redeliveries, orders that go on, a lost checkpoint."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from orderpulse.session import scratch_path
from orderpulse.sinks.raw import land_batch
from orderpulse.streaming import land_merge as P
from orderpulse.streaming import stalled

BIG = 2 ** 53 + 1  # not a double
SCHEMA = "event_id string, order_id bigint, customer_id bigint, new_status string, status_ts timestamp_ntz, source string"


def event(k, order, day, hour=0, status="PAID"):
    return (f"e{k}", order, 7, status, None if day is None else dt.datetime(2024, 3, day, hour), "t")


WAVES = [
    [event(1, BIG, 1), event(2, BIG, 1, 20), event(3, 2, 1), event(4, None, 1), event(5, 3, None), event(6, 4, 1, 5)],
    [event(6, 4, 1, 5), event(7, 2, 5), event(8, 2, 5, 3, None)],  # the first again, an order that goes on
    [event(9, 5, 9)],
]


def rows(df):
    return sorted((r.order_id, r.active_from, r.event_id, r.stalled_at) for r in df.collect())


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(request, spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def drained(spark, paths):
    for k, wave in enumerate(WAVES):
        land_batch(spark.createDataFrame(wave, SCHEMA), paths.raw, k)
        P.run_to_completion(stalled.start_stalls(spark, paths, trigger="drain"))


def test_stalls_of_waves(spark, zone):
    paths = P.PipelinePaths(scratch_path(spark, "test_stalls"))
    assert stalled.read_stalls(spark, paths).count() == 0
    drained(spark, paths)
    day = lambda d, h=0: dt.datetime(2024, 3, d, h)
    want = [(2, day(1), "e3", day(2)), (2, day(5), "e8", day(6, 3)), (4, day(1, 5), "e6", day(2, 5)), (BIG, day(1), "e2", day(2, 20))]
    assert rows(stalled.read_stalls(spark, paths)) == want
    every = spark.createDataFrame([e for w in WAVES for e in w], SCHEMA)
    assert rows(stalled.stalls(every, F.lit(day(9)).cast("timestamp_ntz"))) == want
    assert stalled.stalls(every.limit(0), F.lit(day(9)).cast("timestamp_ntz")).count() == 0


def test_a_stall_needs_the_whole_quiet_time(spark):
    events = spark.createDataFrame([event(1, 1, 1), event(2, 1, 2, 0), event(3, 1, 3, 1)], SCHEMA)
    last = lambda d: [r[2] for r in rows(stalled.stalls(events, F.lit(dt.datetime(2024, 3, d)).cast("timestamp_ntz")))]
    assert last(2) == [] and last(3) == ["e2"] and last(5) == ["e2", "e3"]


def test_stalls_that_lost_their_checkpoint_are_refused(spark):
    paths = P.PipelinePaths(scratch_path(spark, "test_stalls"))
    drained(spark, paths)
    before = rows(stalled.read_stalls(spark, paths))
    shutil.move(f"{paths.root}/_checkpoint/stalls", f"{paths.root}/_checkpoint/lost")
    with pytest.raises(ValueError, match="is lost"):
        stalled.start_stalls(spark, paths, trigger="drain")
    assert rows(stalled.read_stalls(spark, paths)) == before


def test_spans_stay_in_the_jvm(spark):
    events = spark.createDataFrame([event(1, 1, 1)], SCHEMA)
    plan = stalled.active_spans(stalled.timed(events))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MergingSessions" in plan
