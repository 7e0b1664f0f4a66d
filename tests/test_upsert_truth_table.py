"""The MERGE truth table: {no target, target} x source ts {older, equal, newer, null}
x source status {same, different, null}, with null target columns too."""

import datetime as dt
import itertools

from orderpulse.operators.upsert import upsert_status
from orderpulse.schemas import STATUS_SCHEMA

T0 = dt.datetime(2024, 1, 10, 12, 0, 0)
TS = {"older": T0 - dt.timedelta(hours=1), "equal": T0, "newer": T0 + dt.timedelta(hours=1), "null": None}


def expected(target, source):
    """Hand-written MERGE semantics with SQL three-valued logic."""
    if target is None:
        return (source[0], source[1], None, source[2], source[3])
    oid, cust, prev, cur, ts = target
    s_ts, s_new = source[3], source[2]
    newer = True if ts is None else (None if s_ts is None else s_ts > ts)
    changed = True if cur is None else (None if s_new is None else cur != s_new)
    if newer is True and changed is True:
        return (oid, source[1], cur, s_new, s_ts)
    return target


def test_truth_table(spark):
    targets, sources, want = [], [], []
    oid = 0
    target_shapes = [None, ("PAID", T0), (None, T0), ("PAID", None), (None, None)]
    for shape, ts_kind, st_kind in itertools.product(target_shapes, TS, ["same", "different", "null"]):
        oid += 1
        cur_for_same = shape[0] if shape and shape[0] else "PAID"
        s_status = {"same": cur_for_same, "different": "SHIPPED", "null": None}[st_kind]
        source = (oid, 900 + oid, s_status, TS[ts_kind])
        target = None if shape is None else (oid, 100 + oid, "CREATED", shape[0], shape[1])
        if target is not None:
            targets.append(target)
        sources.append(source)
        want.append(expected(target, source))
    # a target-only row stays as it is
    targets.append((9999, 1, None, "PAID", T0))
    want.append((9999, 1, None, "PAID", T0))
    t = spark.createDataFrame(targets, STATUS_SCHEMA)
    s = spark.createDataFrame(sources, "order_id long, customer_id long, new_status string, last_event_ts timestamp_ntz")
    got = sorted(tuple(r) for r in upsert_status(t, s).collect())
    assert got == sorted(want)


def test_null_source_key_quarantined(spark):
    t = spark.createDataFrame([], STATUS_SCHEMA)
    s = spark.createDataFrame([(None, 1, "PAID", T0), (5, 2, "PAID", T0)],
                              "order_id long, customer_id long, new_status string, last_event_ts timestamp_ntz")
    rows = upsert_status(t, s).collect()
    assert [r.order_id for r in rows] == [5]


def test_actions(spark):
    t = spark.createDataFrame([(1, 1, None, "PAID", T0), (2, 2, None, "PAID", T0), (3, 3, None, "PAID", T0)],
                              STATUS_SCHEMA)
    s = spark.createDataFrame([(1, 1, "SHIPPED", TS["newer"]), (2, 2, "SHIPPED", TS["older"]), (4, 4, "PAID", T0)],
                              "order_id long, customer_id long, new_status string, last_event_ts timestamp_ntz")
    got = {r.order_id: r._action for r in upsert_status(t, s, with_action=True).collect()}
    assert got == {1: "update", 2: "unchanged", 3: "kept", 4: "insert"}
