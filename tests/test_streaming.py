"""Streaming pipeline behaviour on hand-made message files."""

import json

import pytest

from orderpulse.session import scratch_path
from orderpulse.sinks.raw import read_raw
from orderpulse.sinks.snapshot import SnapshotStore
from orderpulse.streaming import land_merge as P
from orderpulse.streaming.sources import file_messages


def msg(eid, oid, status, ts, cust=1):
    return json.dumps({"event_id": eid, "order_id": oid, "customer_id": cust, "new_status": status,
                       "status_ts": ts, "source": "test"})


def publish(spark, landing, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(landing)


def drain(spark, landing, paths, mode="incremental", **kw):
    P.run_to_completion(P.start_land_merge(file_messages(spark, landing), paths, mode, trigger="drain", **kw))


def status(store):
    return {r.order_id: (r.previous_status, r.current_status, str(r.last_update_ts))
            for r in store.read_status().collect()}


def test_quarantine_late_duplicate_and_restart(spark):
    root = scratch_path(spark, "test_stream")
    paths, landing = P.PipelinePaths(root), f"{root}/landing"
    store = SnapshotStore(spark, paths.store)
    publish(spark, landing, [
        msg("e1", 1, "CREATED", "2024-01-01T10:00:00+00:00"),
        msg("e2", 1, "PAID", "2024-01-01T11:00:00+00:00"),
        msg("e3", 2, "CREATED", "2024-01-01T10:00:00+02:00"),
        "{not json",
        json.dumps({"event_id": "e4", "customer_id": 1, "new_status": "PAID",
                    "status_ts": "2024-01-01T12:00:00+00:00"}),
        msg("e9", 9, "PAID", "yesterday-ish"),
    ])
    drain(spark, landing, paths)
    assert status(store) == {1: (None, "PAID", "2024-01-01 11:00:00"),
                             2: (None, "CREATED", "2024-01-01 08:00:00")}
    log = store.run_log().collect()
    assert [(r.batch_id, r.rows_in, r.rows_bad, r.inserted) for r in log] == [(0, 3, 3, 2)]
    bad = {(r.reason, r.value) for r in P.quarantined(spark, paths).collect()}
    assert {r for r, _ in bad} == {"bad status_ts", "malformed", "missing order_id"}
    assert ("malformed", "{not json") in bad  # the text is kept

    # second wave: a late event (older than current) and a duplicate of e2
    publish(spark, landing, [msg("e0", 1, "SHIPPED", "2024-01-01T09:00:00+00:00"),
                             msg("e2", 1, "PAID", "2024-01-01T11:00:00+00:00"),
                             msg("e5", 2, "PACKED", "2024-01-02T00:00:00+00:00")])
    drain(spark, landing, paths)
    assert status(store) == {1: (None, "PAID", "2024-01-01 11:00:00"),
                             2: ("CREATED", "PACKED", "2024-01-02 00:00:00")}
    assert read_raw(spark, paths.raw).count() == 6

    # nothing new: a restart from the checkpoint processes nothing and commits nothing
    versions = store.commits().count()
    drain(spark, landing, paths)
    assert store.commits().count() == versions


def test_replayed_batch_is_skipped(spark):
    root = scratch_path(spark, "test_replay")
    paths = P.PipelinePaths(root)
    store = SnapshotStore(spark, paths.store)
    from orderpulse.sources.messages import decode_messages

    batch = decode_messages(spark.createDataFrame(
        [(msg("a", 7, "PAID", "2024-01-01T00:00:00+00:00"),)], "value string"))
    sink = P.LandAndMerge(paths)
    sink(batch, 0)
    sink(batch, 0)  # Spark re-delivers the batch after a failure before the offset commit
    P.LandAndMerge(paths)(batch, 0)  # ... or after a driver restart
    assert store.commits().count() == 1
    assert read_raw(spark, paths.raw).count() == 1


def test_day_grain_and_dedupe(spark):
    root = scratch_path(spark, "test_day")
    paths, landing = P.PipelinePaths(root), f"{root}/landing"
    store = SnapshotStore(spark, paths.store)
    publish(spark, landing, [msg("a", 1, "CREATED", "2024-01-01T10:00:00+00:00"),
                             msg("a", 1, "CREATED", "2024-01-01T10:00:00+00:00"),
                             msg("b", 1, "PAID", "2024-01-01T11:00:00+00:00")])
    drain(spark, landing, paths, ts_grain="day", dedupe=True)
    publish(spark, landing, [msg("c", 1, "SHIPPED", "2024-01-01T23:00:00+00:00")])
    drain(spark, landing, paths, ts_grain="day", dedupe=True)
    # same day: the strict "newer" guard keeps the first status of the day (date grain)
    assert status(store) == {1: (None, "PAID", "2024-01-01 00:00:00")}
    assert read_raw(spark, paths.raw).count() == 3


def test_one_writer_per_store(spark):
    import pytest

    root = scratch_path(spark, "test_owner")
    paths, landing = P.PipelinePaths(root), f"{root}/landing"
    publish(spark, landing, [msg("a", 1, "CREATED", "2024-01-01T10:00:00+00:00")])
    drain(spark, landing, paths)
    with pytest.raises(ValueError):
        P.start_refresh(spark, paths, trigger="drain")


def test_query_status_lists_running_queries(spark):
    root = scratch_path(spark, "test_status")
    paths, landing = P.PipelinePaths(root), f"{root}/landing"
    publish(spark, landing, [msg("a", 1, "CREATED", "2024-01-01T10:00:00+00:00")])
    q = P.start_land_merge(file_messages(spark, landing), paths, trigger="flush")
    try:
        q.processAllAvailable()
        rows = P.query_status(spark).collect()
        assert any(r.id == str(q.id) for r in rows)
    finally:
        q.stop()
    assert status(SnapshotStore(spark, paths.store)) == {1: (None, "CREATED", "2024-01-01 10:00:00")}


def test_stateful_variant_agrees_with_snapshot_pipeline(spark):
    from orderpulse.streaming.stateful import start_stateful_merge

    big = 2 ** 53 + 1  # not a double
    root, other = scratch_path(spark, "test_stateful"), P.PipelinePaths(scratch_path(spark, "test_stateful_b"))
    paths, landing = P.PipelinePaths(root), f"{root}/landing"
    waves = [
        [msg("e1", 1, "CREATED", "2024-01-01T10:00:00+00:00", big), msg("e2", 1, "PAID", "2024-01-01T11:00:00+00:00", big),
         msg("e3", 2, "CREATED", "2024-01-01T10:00:00+02:00", None), "{not json", msg("n1", 3, None, None)],
        [msg("e0", 1, "SHIPPED", "2024-01-01T09:00:00+00:00"), msg("e2", 1, "PAID", "2024-01-01T11:00:00+00:00", big),
         msg("e5", 2, "PACKED", "2024-01-02T00:00:00+00:00", None), msg("n2", 3, "PAID", None)],
        [msg("e6", 1, "PAID", "2024-01-03T00:00:00+00:00", big), msg("e7", 3, "SHIPPED", "2024-01-01T00:00:00+00:00")],
    ]
    for lines in waves:
        publish(spark, landing, lines)
        drain(spark, landing, paths)
        P.run_to_completion(P.start_raw_landing(file_messages(spark, landing), other, trigger="drain"))
        P.run_to_completion(start_stateful_merge(spark, other, trigger="drain"))
    want, got = SnapshotStore(spark, paths.store), SnapshotStore(spark, other.store)
    assert status(got) == status(want)
    assert {r.order_id: r.customer_id for r in got.read_status().collect()} == {1: big, 2: None, 3: 1}
    assert status(want)[1] == (None, "PAID", "2024-01-01 11:00:00")  # same status later: guard holds it
    assert status(want)[3] == ("PAID", "SHIPPED", "2024-01-01 00:00:00")
    assert P.quarantined(spark, other).count() == 1  # bad messages are kept in this shape too


def event_rows(spark, *orders):
    return spark.createDataFrame([(f"e{o}", o, 1, "PAID", None, "t", 0) for o in orders],
                                 "event_id string, order_id long, customer_id long, new_status string, "
                                 "status_ts timestamp_ntz, source string, batch_id long")


def test_commit_log_blocks(spark, monkeypatch):
    import os

    import orderpulse.sinks.snapshot as snap

    monkeypatch.setattr(snap, "COMMITS_PER_BLOCK", 2)
    store = SnapshotStore(spark, scratch_path(spark, "test_blocks"), buckets=2)
    for b in range(5):
        P.merge_batch(store, event_rows(spark, 1), b, "src", "incremental", 1, 0, None)
    c = store.latest_commit()
    assert (c.version, c.batch_id, c.buckets) == (4, 4, 2)
    assert store.commits().count() == 5
    assert sorted(os.listdir(store.root + "/_commits")) == ["block=0000000000", "block=0000000001", "block=0000000002"]


def test_retry_over_leftover_uncommitted_version(spark):
    store = SnapshotStore(spark, scratch_path(spark, "test_retry"), buckets=2)
    spark.range(5).write.parquet(f"{store.state_path(0)}/bucket=0")  # a failed attempt's files, never committed
    assert store.latest_commit() is None
    c = P.merge_batch(store, event_rows(spark, 1), 0, "src", "incremental", 1, 0, None)
    assert c.version == 0 and [r.current_status for r in store.read_status().collect()] == ["PAID"]


def parts(store):
    import glob

    return {p[len(store.root) + 7:].rsplit("/", 1)[0] for p in glob.glob(f"{store.root}/state/v=*/bucket=*/part-*")}


def test_one_order_rewrites_one_bucket_and_old_copies_go(spark):
    store = SnapshotStore(spark, scratch_path(spark, "test_buckets"), buckets=8)
    P.merge_batch(store, event_rows(spark, *range(100)), 0, "src", "incremental", 100, 0, None)
    first = parts(store)
    assert len(first) == 8
    for b in range(1, 16):
        P.merge_batch(store, event_rows(spark, 7), b, "src", "incremental", 1, 0, None)
        new = {p for p in parts(store) if p.startswith(f"v={b}/")}
        assert len(new) == 1
    from orderpulse.sinks.snapshot import KEEP

    assert len(parts(store)) <= 8 + KEEP  # one copy of the others, at most KEEP of the touched one
    assert store.read_status().count() == 100 and store.read_status(version=12).count() == 100


def test_null_status_settles_as_in_a_full_rescan(spark):
    """An order whose latest event has neither time nor status is merged again by every rescan."""
    full = SnapshotStore(spark, scratch_path(spark, "test_full"), buckets=4)
    inc = SnapshotStore(spark, scratch_path(spark, "test_inc"), buckets=4)
    schema = event_rows(spark, 1).schema
    waves = [[("a", 1, 1, "PAID", None, "t", 0)], [("b", 1, 1, None, None, "t", 1)], [("c", 2, 1, "PAID", None, "t", 2)],
             [("d", 3, 1, "PAID", None, "t", 3)]]
    seen = spark.createDataFrame([], schema)
    for i, rows in enumerate(waves):
        delta = spark.createDataFrame(rows, schema)
        seen = seen.unionByName(delta)
        P.merge_batch(full, delta, i, "src", "full", 1, 0, None, seen)
        P.merge_batch(inc, delta, i, "src", "incremental", 1, 0, None)
        assert status(full) == status(inc), i


def test_restart_with_another_checkpoint_is_refused(spark):
    import pytest

    root = scratch_path(spark, "test_lost")
    paths, landing = P.PipelinePaths(root), f"{root}/landing"
    publish(spark, landing, [msg("a", 1, "CREATED", "2024-01-01T10:00:00+00:00")])
    drain(spark, landing, paths)

    class Elsewhere(P.PipelinePaths):
        checkpoint = f"{root}/_checkpoint/new"

    with pytest.raises(ValueError, match="checkpoint"):
        drain(spark, landing, Elsewhere(root))


def test_empty_batch_writes_nothing(spark):
    import os

    from orderpulse.sources.messages import decode_messages

    paths = P.PipelinePaths(scratch_path(spark, "test_empty"))
    P.LandAndMerge(paths)(decode_messages(spark.createDataFrame([], "value string")), 0)
    assert not os.path.exists(paths.raw) and SnapshotStore(spark, paths.store).latest_commit() is None


def test_only_bad_messages(spark):
    import os

    from orderpulse.sources.messages import decode_messages

    paths = P.PipelinePaths(scratch_path(spark, "test_bad"))
    P.LandAndMerge(paths)(decode_messages(spark.createDataFrame([("x",), (json.dumps({"event_id": "x", "order_id": 5}),)],
                                                                "value string")), 0)
    assert not os.path.exists(paths.raw)
    assert sorted(r.reason for r in P.quarantined(spark, paths).collect()) == ["malformed", "missing customer_id"]
    log = SnapshotStore(spark, paths.store).run_log().collect()
    assert [(r.rows_in, r.rows_bad) for r in log] == [(0, 2)]


def test_synthetic_ids_differ(spark):
    from orderpulse.sources.messages import decode_messages

    texts = [json.dumps({"order_id": 1, "customer_id": None, "new_status": s, "status_ts": t})
             for s, t in (("a", None), (None, "a"), ("", None), (None, None), ("a|b", None))]
    rows = decode_messages(spark.createDataFrame([(t,) for t in texts], "value string")).collect()
    assert len({r.event_id for r in rows}) == len(texts)


def test_explicit_null_is_not_an_absent_key(spark):
    from orderpulse.sources.messages import decode_messages

    row = decode_messages(spark.createDataFrame([(msg("a", 1, None, None, None),)], "value string")).first()
    assert row._bad is None and row.new_status is None


def test_utc_in_the_hour_that_comes_twice(spark):
    from orderpulse.sources.messages import decode_messages

    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        texts = [msg("a", 1, "PAID", t) for t in ("2024-10-27T00:30:00+00:00", "2024-10-27T01:30:00+00:00",
                                                  "2024-10-27T03:30:00+02:00", "1969-12-31T23:59:59.999999+00:00")]
        got = [str(r.status_ts) for r in decode_messages(spark.createDataFrame([(t,) for t in texts], "value string")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == ["2024-10-27 00:30:00", "2024-10-27 01:30:00", "2024-10-27 01:30:00", "1969-12-31 23:59:59.999999"]


def test_pipeline_lands_on_flush_and_merges_on_schedule(spark):
    root = scratch_path(spark, "test_pipeline")
    paths, landing = P.PipelinePaths(root), f"{root}/landing"
    publish(spark, landing, [msg("a", 1, "CREATED", "2024-01-01T10:00:00+00:00"), "bad"])
    queries = P.start_pipeline(file_messages(spark, landing), paths)
    try:
        for q in queries:
            q.processAllAvailable()
        assert status(SnapshotStore(spark, paths.store)) == {1: (None, "CREATED", "2024-01-01 10:00:00")}
        assert P.quarantined(spark, paths).count() == 1
    finally:
        for q in queries:
            q.stop()


def lose(path):
    """The checkpoint is gone: another one stands in its place."""
    import shutil

    shutil.move(path, path + "-lost")


E1 = msg("e1", 1, "CREATED", "2024-01-01T10:00:00+00:00")
E2 = msg("e2", 2, "PAID", "2024-01-01T11:00:00+00:00")
E3 = msg("e3", 3, "PAID", "2024-01-01T12:00:00+00:00")


@pytest.mark.parametrize("shape", ["one query", "landing"])
def test_a_landing_query_that_lost_its_checkpoint_is_refused(spark, shape):
    root = scratch_path(spark, "test_owner")
    paths, landing = P.PipelinePaths(root), f"{root}/landing"
    start = P.start_land_merge if shape == "one query" else P.start_raw_landing
    publish(spark, landing, [E1, E2, "bad one"])
    P.run_to_completion(start(file_messages(spark, landing), paths, trigger="drain"))
    lose(paths.checkpoint if shape == "one query" else paths.landing_checkpoint)
    publish(spark, landing, [E3, "bad two"])
    with pytest.raises(ValueError, match="belongs to"):
        start(file_messages(spark, landing), paths, trigger="drain")
    assert sorted(r.event_id for r in read_raw(spark, paths.raw).collect()) == ["e1", "e2"]
    assert [r.value for r in P.quarantined(spark, paths).collect()] == ["bad one"]


def test_the_other_shape_does_not_land_into_the_same_folder(spark):
    root = scratch_path(spark, "test_owner")
    paths, landing = P.PipelinePaths(root), f"{root}/landing"
    publish(spark, landing, [E1])
    P.run_to_completion(P.start_raw_landing(file_messages(spark, landing), paths, trigger="drain"))
    with pytest.raises(ValueError, match="belongs to"):
        P.start_land_merge(file_messages(spark, landing), paths, trigger="drain")
    other = P.PipelinePaths(scratch_path(spark, "test_owner"))
    read_raw(spark, paths.raw).drop("batch_id").write.parquet(f"{other.raw}/batch_id=0")
    with pytest.raises(ValueError, match="no landing query"):  # data of nobody on record is not overwritten either
        P.start_raw_landing(file_messages(spark, landing), other, trigger="drain")


def test_a_stateful_merge_that_lost_its_checkpoint_is_refused(spark):
    from orderpulse.streaming.stateful import start_stateful_merge

    root = scratch_path(spark, "test_owner")
    paths, landing = P.PipelinePaths(root), f"{root}/landing"
    publish(spark, landing, [E1, "bad"])
    P.run_to_completion(P.start_raw_landing(file_messages(spark, landing), paths, trigger="drain"))
    P.run_to_completion(start_stateful_merge(spark, paths, trigger="drain"))
    lose(f"{root}/_checkpoint/stateful")
    with pytest.raises(ValueError, match="belongs to"):
        start_stateful_merge(spark, paths, trigger="drain")
    assert [r.rows_bad for r in SnapshotStore(spark, paths.store).run_log().collect()] == [1]


def test_run_log_counts_batches_of_bad_messages_alone(spark):
    root = scratch_path(spark, "test_bad_waves")
    paths, landing = P.PipelinePaths(root), f"{root}/landing"
    for wave in ([E1], ["bad", "{}"], [E2, "bad"], ["last"]):
        publish(spark, landing, wave)
        P.run_to_completion(P.start_raw_landing(file_messages(spark, landing), paths, trigger="drain"))
        P.run_to_completion(P.start_refresh(spark, paths, trigger="drain"))
    log = SnapshotStore(spark, paths.store).run_log().orderBy("batch_id").collect()
    assert [(r.rows_in, r.rows_bad) for r in log] == [(1, 0), (0, 2), (1, 1), (0, 1)]
    assert [(n.batch_id, n.good, n.bad) for n in paths.log(spark).after(-1)] == [(0, 1, 0), (1, 0, 2), (2, 1, 1), (3, 0, 1)]
    assert [n.batch_id for n in paths.log(spark).after(0, up_to=2)] == [1, 2]


@pytest.mark.parametrize("mode", ["incremental", "full"])
def test_batch_refresh_takes_what_the_log_tells(spark, mode):
    root = scratch_path(spark, "test_log_refresh")
    paths, landing = P.PipelinePaths(root), f"{root}/landing"
    for wave in ([E1], ["bad"], [E2, "bad"], [msg("e4", 1, "PAID", "2024-01-02T10:00:00+00:00"), E3]):
        publish(spark, landing, wave)
        P.run_to_completion(P.start_raw_landing(file_messages(spark, landing), paths, trigger="drain"))
    P.refresh(spark, paths, mode, up_to_batch=1)
    assert P.refresh(spark, paths, mode).batch_id == 3
    assert P.refresh(spark, paths, mode) is None
    store = SnapshotStore(spark, paths.store)
    assert status(store) == {1: ("CREATED", "PAID", "2024-01-02 10:00:00"), 2: (None, "PAID", "2024-01-01 11:00:00"),
                             3: (None, "PAID", "2024-01-01 12:00:00")}
    log = store.run_log().orderBy("batch_id").collect()
    assert [(r.batch_id, r.rows_in, r.rows_bad, str(r.max_status_ts)) for r in log] == [
        (1, 1, 1, "2024-01-01 10:00:00"), (3, 3, 1, "2024-01-02 10:00:00")]


def test_landing_log_over_blocks(spark):
    from orderpulse.sinks.landing import PER_BLOCK, Landed

    log = P.PipelinePaths(scratch_path(spark, "test_log")).log(spark)
    log.claim("q")
    for n in (0, 1, PER_BLOCK - 1, PER_BLOCK, PER_BLOCK + 5):
        log.record(Landed(n, 1, 0))
    log.record(Landed(1, 2, 3, "2024-01-01 00:00:00"))  # landed again
    assert [n.batch_id for n in log.after(-1)] == [0, 1, PER_BLOCK - 1, PER_BLOCK, PER_BLOCK + 5]
    assert [n.batch_id for n in log.after(PER_BLOCK - 1)] == [PER_BLOCK, PER_BLOCK + 5]
    assert log.after(0, up_to=1) == [Landed(1, 2, 3, "2024-01-01 00:00:00")]
    with pytest.raises(ValueError, match="belongs to"):
        log.claim("r")


def test_day_grain_in_two_queries(spark):
    root = scratch_path(spark, "test_grain")
    paths, landing = P.PipelinePaths(root), f"{root}/landing"
    publish(spark, landing, [E1])
    P.run_to_completion(P.start_raw_landing(file_messages(spark, landing), paths, trigger="drain", ts_grain="day"))
    P.run_to_completion(P.start_refresh(spark, paths, trigger="drain"))
    assert status(SnapshotStore(spark, paths.store)) == {1: (None, "CREATED", "2024-01-01 00:00:00")}


def test_pipeline_triggers(spark, monkeypatch):
    """A topic's flush size counts only where the landing query starts with the source's batches."""
    told = []
    monkeypatch.setattr(P, "with_trigger", lambda writer, kind: told.append(kind) or writer)

    class Writer:
        def __getattr__(self, name):
            return lambda *a, **k: self

    monkeypatch.setattr(P, "decoded_stream", lambda *a: type("D", (), {"writeStream": Writer()})())
    monkeypatch.setattr(P, "raw_stream", lambda *a: type("D", (), {"writeStream": Writer()})())
    messages = type("M", (), {"sparkSession": spark})()
    P.start_pipeline(messages, P.PipelinePaths(scratch_path(spark, "test_trigger")))
    P.start_pipeline(messages, P.PipelinePaths(scratch_path(spark, "test_trigger")), landing_trigger="flush")
    assert told == ["arrival", "schedule", "flush", "schedule"]


class StubIO:
    """Records what a reader or writer is told."""

    def __init__(self, result=None):
        self.kind, self.options, self.result, self.saved = None, {}, result, False

    def format(self, kind):
        self.kind = kind
        return self

    def option(self, key, value):
        self.options[key] = value
        return self

    def load(self):
        return self.result

    def save(self):
        self.saved = True


def test_kafka_contract(spark):
    from orderpulse.sinks.topic import kafka_rows, publish_kafka
    from orderpulse.streaming.sources import kafka_messages, trigger_options

    topic = spark.createDataFrame([(b"{}", "orders", 0, 5)], "value binary, topic string, partition int, offset long")
    stub = StubIO(topic)
    rows = kafka_messages(spark, "host:1", "orders", reader=stub, starting_offsets="earliest", max_rows=1000).collect()
    assert stub.kind == "kafka" and stub.options == {
        "kafka.bootstrap.servers": "host:1", "subscribe": "orders", "startingOffsets": "earliest",
        "minOffsetsPerTrigger": "200", "maxTriggerDelay": "10s", "maxOffsetsPerTrigger": "1000"}
    assert [(r.value, r.offset) for r in rows] == [("{}", 5)]
    assert trigger_options("arrival") == {}  # size or time, whichever is first: no fixed tick beside them

    events = event_rows(spark, 1, 2)
    out = StubIO()
    publish_kafka(events, "host:1", "orders", "customer_id", [0, 1], writer=out)
    assert out.saved and out.options == {"kafka.bootstrap.servers": "host:1", "topic": "orders"}
    assert kafka_rows(events, "customer_id", [0, 1]).columns == ["value", "key", "partition"]
