"""Properties of the merge over arrival batches (random histories with ties and nulls)."""

import datetime as dt
import random

from pyspark.sql import functions as F

from orderpulse.operators.upsert import advance_state, empty_state
from orderpulse.plans.replay import replay_fold, replay_state, replay_status

EVENTS_DDL = ("event_id string, order_id long, customer_id long, new_status string, "
              "status_ts timestamp_ntz, source string, batch_id long")
STATUSES = ["CREATED", "PAID", "PACKED", "SHIPPED", "DELIVERED", None]


def random_events(seed, n_orders=25, n_events=300, n_batches=6, hot_share=0.0):
    rng = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n_events):
        ts = None if rng.random() < 0.05 else base + dt.timedelta(minutes=rng.randint(0, 40))  # ties
        order = 0 if rng.random() < hot_share else rng.randint(0, n_orders - 1)
        rows.append((f"{rng.randint(0, 60):04d}", order, rng.randint(1, 5),
                     rng.choice(STATUSES), ts, "test", rng.randint(0, n_batches - 1)))
    return rows


def split(rng, n_batches):
    ids = list(range(n_batches))
    groups, cur = [], []
    for b in ids:
        cur.append(b)
        if rng.random() < 0.5:
            groups.append(cur)
            cur = []
    if cur:
        groups.append(cur)
    return groups


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_full_equals_incremental(spark):
    for seed in range(4):
        ev = spark.createDataFrame(random_events(seed), EVENTS_DDL)
        groups = split(random.Random(seed), 6)
        full = rows(replay_status(ev, groups, "full"))
        inc = rows(replay_status(ev, groups, "incremental"))
        fold = rows(replay_fold(ev, groups))
        assert full == inc, (seed, groups)
        assert full == fold, (seed, groups)


def test_remerge_is_idempotent_and_keys_unique(spark):
    ev = spark.createDataFrame(random_events(7), EVENTS_DDL)
    st = replay_state(ev, [[0, 1, 2], [3, 4, 5]], "incremental")
    again = advance_state(st, ev.limit(0))
    assert rows(st) == rows(again)
    assert st.groupBy("order_id").count().where("count > 1").count() == 0


def test_last_update_never_decreases(spark):
    ev = spark.createDataFrame(random_events(11), EVENTS_DDL)
    state = empty_state(spark)
    prev = {}
    for b in range(6):
        state = advance_state(state, ev.where(F.col("batch_id") == b))
        cur = {r.order_id: r.last_update_ts for r in state.collect()}
        for k, ts in prev.items():
            if ts is not None:
                assert cur[k] is not None and cur[k] >= ts
        prev = cur


def test_delta_only_differs_somewhere(spark):
    # Merging only each batch's own latest is not the reference semantics.
    diffs = 0
    for seed in range(4):
        ev = spark.createDataFrame(random_events(seed, n_batches=5), EVENTS_DDL)
        groups = [[0], [1], [2], [3], [4]]
        diffs += rows(replay_status(ev, groups, "full")) != rows(replay_status(ev, groups, "delta_only"))
    assert diffs > 0


def test_hot_order_full_equals_incremental_and_fold(spark):
    # one order holds a third of all events
    ev = spark.createDataFrame(random_events(21, n_events=900, hot_share=1 / 3), EVENTS_DDL).repartition(8)
    groups = [[0, 1], [2], [3, 4, 5]]
    full = rows(replay_status(ev, groups, "full"))
    assert full == rows(replay_status(ev, groups, "incremental"))
    assert full == rows(replay_fold(ev, groups))


def test_no_mismatch_without_ties_or_nulls(spark):
    from orderpulse.operators.validate import latest_mismatch

    rng = random.Random(5)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(400):  # distinct timestamps, no null status: the latest event always wins
        rows.append((f"{i:05d}", rng.randint(0, 19), 1, rng.choice(STATUSES[:-1]),
                     base + dt.timedelta(seconds=i * 7 + rng.randint(0, 6)), "test", rng.randint(0, 5)))
    ev = spark.createDataFrame(rows, EVENTS_DDL)
    for groups in ([[0, 1, 2, 3, 4, 5]], [[0], [1], [2], [3], [4], [5]], [[3], [0, 5], [1, 2, 4]]):
        for status in (replay_status(ev, groups, "incremental"), replay_fold(ev, groups)):
            assert latest_mismatch(ev, status).first().mismatches == 0


def test_running_totals_across_blocks(spark):
    from orderpulse.operators.validate import running_totals

    rows = [(i, (i * 7) % 5) for i in range(0, 250, 3)]
    df = spark.createDataFrame(rows, "b long, x long")
    got = {r.b: (r.total_x, r.prev_total_x) for r in running_totals(df, "b", ["x"], block=10).collect()}
    acc = 0
    for b, x in rows:
        assert got[b] == (acc + x, acc)
        acc += x
