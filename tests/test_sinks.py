"""Table lifecycle and publishing."""

import datetime as dt

import pytest

from orderpulse.schemas import EVENT_SCHEMA, STATUS_SCHEMA
from orderpulse.session import scratch_path
from orderpulse.sinks.tables import append_table, ensure_database, ensure_table, load_table
from orderpulse.sinks.topic import publish_files, with_event_ids
from orderpulse.sources.messages import decode_messages


def test_ensure_load_append(spark):
    root = scratch_path(spark, "test_tables")
    ensure_database(spark, "orderpulse_test")
    t = ensure_table(spark, f"{root}/status", STATUS_SCHEMA)
    assert t.count() == 0 and t.schema == STATUS_SCHEMA
    rows = spark.createDataFrame([(1, 2, None, "PAID", dt.datetime(2024, 1, 1))], STATUS_SCHEMA)
    append_table(rows, f"{root}/status", STATUS_SCHEMA)
    assert ensure_table(spark, f"{root}/status", STATUS_SCHEMA).count() == 1
    assert ensure_table(spark, f"{root}/status", STATUS_SCHEMA, replace=True).count() == 0
    with pytest.raises(ValueError):
        append_table(rows.drop("customer_id"), f"{root}/status", STATUS_SCHEMA)
    with pytest.raises(ValueError):
        append_table(rows, f"{root}/missing", STATUS_SCHEMA)
    load_table(rows.select("order_id", "current_status"), f"{root}/narrow")
    assert spark.read.parquet(f"{root}/narrow").columns == ["order_id", "current_status"]


def test_publish_round_trip(spark):
    root = scratch_path(spark, "test_publish")
    ev = spark.createDataFrame([(None, 1, 2, "PAID", dt.datetime(2024, 1, 1, 5, 6, 7, 123456), "t")], EVENT_SCHEMA)
    publish_files(with_event_ids(ev), root)
    back = decode_messages(spark.read.text(root)).collect()
    assert len(back) == 1 and back[0]._bad is None
    assert back[0].status_ts == dt.datetime(2024, 1, 1, 5, 6, 7, 123456)
    assert len(back[0].event_id) == 36


def test_size_strings_and_bound(spark):
    from orderpulse.operators.joins import parse_bytes, size_bound_bytes

    assert parse_bytes("10485760b") == parse_bytes("10MB") == parse_bytes("10485760") == 10 << 20
    assert parse_bytes("-1") == -1
    df = spark.createDataFrame([("abcdefghi", 1), (None, 2)], "s string, n long")
    # 2 rows x (bitset word + 2 slots) + words of "abcdefghi" (9 bytes -> 16)
    assert size_bound_bytes(df) == 2 * 24 + 16


def test_approx_unique_orders_and_default_as_of(spark):
    import datetime as dt

    from orderpulse.operators.monitor import event_stats
    from orderpulse.operators.validate import freshness_lag
    from orderpulse.sources.fixtures import fx_events

    from conftest import SF_CHECK

    ev = fx_events(spark, SF_CHECK)
    exact = event_stats(ev).first().unique_orders
    approx = event_stats(ev, approx_rsd=0.02).first().unique_orders
    assert abs(approx - exact) <= 0.06 * exact
    row = freshness_lag(ev, None, 60).first()
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert abs((row.as_of - now).total_seconds()) < 600 and row.is_fresh is False


def test_dashboard_on_empty_status_says_na(spark):
    from orderpulse.operators.monitor import dashboard_metrics, status_counts_slice
    from orderpulse.operators.upsert import empty_status
    from orderpulse.sources.fixtures import fx_events

    from conftest import SF_SMALL

    row = dashboard_metrics(empty_status(spark), fx_events(spark, SF_SMALL)).first()
    assert row.latest_update == "N/A" and row.tracked_orders == 0 and row.tracked_orders_full == 0
    assert row.total_events == 1000 and row.unique_orders == 15
    assert status_counts_slice(empty_status(spark)).count() == 0


def test_land_and_read_one_batch(spark):
    import datetime as dt

    from orderpulse.schemas import EVENT_SCHEMA
    from orderpulse.sinks.raw import land_batch, read_batch, read_raw

    root = scratch_path(spark, "test_raw")
    rows = lambda n: spark.createDataFrame(
        [(f"e{i}", i, 1, "PAID", dt.datetime(2024, 1, 1), "t") for i in range(n)], EVENT_SCHEMA)
    land_batch(rows(3), root, 0)
    land_batch(rows(2), root, 1)
    land_batch(rows(4), root, 1)  # a replayed batch replaces its partition
    b1 = read_batch(spark, root, 1)
    assert b1.count() == 4 and {r.batch_id for r in b1.collect()} == {1}
    assert read_raw(spark, root).count() == 7 and read_raw(spark, root, [0]).count() == 3
