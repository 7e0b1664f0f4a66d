"""Data-quality checks that reconcile raw events with the status table.

All checks are aggregates or anti/inner joins on ``order_id``; the one
sequence check (transitions) uses the skew-safe previous-row operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse.operators.latest import latest_status
from orderpulse.operators.sequence import with_previous, with_previous_window
from orderpulse.schemas import STATUSES


def validate_counts(events: DataFrame, status: DataFrame) -> DataFrame:
    """raw_events, raw_orders (distinct order ids in events), dwh_orders: one row.

    The status table has one row per order, so it reconciles with raw_orders,
    not raw_events. Each table is aggregated once; the one-row results are combined
    without a join.
    """
    from orderpulse.operators.joins import combine_one_row

    raw = events.agg(F.count(F.lit(1)).alias("raw_events"),
                     F.countDistinct("order_id").alias("raw_orders"))
    dwh = status.agg(F.count(F.lit(1)).alias("dwh_orders"))
    return combine_one_row(raw, dwh)


def validate_freshness(status: DataFrame) -> DataFrame:
    return status.agg(F.max("last_update_ts").alias("dwh_last_update"))


def status_distribution(status: DataFrame) -> DataFrame:
    """current_status, n -- ordered by n desc, then status."""
    return (status.groupBy("current_status").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col("current_status").asc_nulls_last()))


def orphan_orders(status: DataFrame, orders: DataFrame) -> DataFrame:
    """missing_in_raw_orders: status rows whose order_id is absent from raw orders.

    Written as a left anti join (Catalyst keeps LEFT JOIN + IS NULL as an outer
    join plus filter). A null status key has no match and is counted, as in SQL.
    """
    ids = orders.select(F.col("order_id").alias("_oid"))
    missing = status.select("order_id").join(ids, F.col("order_id") == F.col("_oid"), "left_anti")
    return missing.agg(F.count(F.lit(1)).alias("missing_in_raw_orders"))


def latest_mismatch(events: DataFrame, status: DataFrame) -> DataFrame:
    """mismatches: orders whose latest event's status differs from current_status (nulls not counted)."""
    latest = latest_status(events).select("order_id", "new_status")
    joined = latest.join(status.select("order_id", "current_status"), "order_id")
    return joined.where(F.col("new_status") != F.col("current_status")).agg(
        F.count(F.lit(1)).alias("mismatches"))


def duplicate_events(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Keys delivered more than once: key, copies. Map-side partial counts absorb hot keys."""
    return (events.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
            .where(F.col("copies") > 1))


def duplicate_orders(status: DataFrame) -> DataFrame:
    """Primary-key check on the status table: order_id, copies (expected empty)."""
    return duplicate_events(status, "order_id")


def status_ordinal(status: Column) -> Column:
    expr = None
    for i, s in enumerate(STATUSES):
        expr = F.when(status == s, i) if expr is None else expr.when(status == s, i)
    return expr


def transition_class(prev: Column, cur: Column) -> Column:
    a, b = status_ordinal(prev), status_ordinal(cur)
    step = b - a
    return (F.when(a.isNull() | b.isNull(), "unknown")
            .when(step == 0, "repeat").when(step == 1, "forward")
            .when(step > 1, "skip").otherwise("backward"))


def status_transitions(events: DataFrame, skew_safe: bool = True) -> DataFrame:
    """Counts of consecutive (from_status, to_status) pairs per order, with their class.

    Order within an order: status_ts, event_id ascending (nulls first). The
    lifecycle order is not guaranteed upstream, so this is a report.
    """
    ev = events.select("order_id", "status_ts", "event_id", "new_status")
    prev = (with_previous if skew_safe else with_previous_window)(
        ev, "order_id", ["status_ts", "event_id"], ["new_status"])
    pairs = prev.where(F.col("has_prev")).select(
        F.col("prev_new_status").alias("from_status"), F.col("new_status").alias("to_status"))
    return (pairs.groupBy("from_status", "to_status")
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("transition", transition_class(F.col("from_status"), F.col("to_status"))))


def freshness_lag(events: DataFrame, as_of: Column | None, max_lag_seconds: int) -> DataFrame:
    """latest_event_ts, as_of, lag_seconds (whole seconds, floor), is_fresh.

    ``as_of`` defaults to the current time as a UTC wall clock (tests pin a literal).
    """
    if as_of is None:
        from orderpulse.functions.scalars import instant_to_utc_ntz

        as_of = instant_to_utc_ntz(F.current_timestamp())
    latest = events.agg(F.max("status_ts").alias("latest_event_ts"))
    lag = F.floor(F.timestamp_diff("MICROSECOND", F.col("latest_event_ts"), as_of) / F.lit(1_000_000))
    return latest.select(
        "latest_event_ts", as_of.alias("as_of"), lag.cast("bigint").alias("lag_seconds"),
        (lag <= F.lit(max_lag_seconds)).alias("is_fresh"))


def running_totals(df: DataFrame, order_col: str, value_cols: list[str], block: int = 100_000) -> DataFrame:
    """Running sums ordered by an integer column, without a single-task window.

    Rows are windowed within blocks of ``block`` consecutive ``order_col`` values; the
    blocks' own running totals (one row per block) give each block its offset, joined
    back on the block id. Adds ``total_<v>`` and ``prev_total_<v>`` (the total before the row).
    """
    from pyspark.sql import Window

    blk = F.floor(F.col(order_col) / F.lit(block)).cast("bigint")
    df = df.withColumn("_blk", blk)
    inner = Window.partitionBy("_blk").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    totals = df.groupBy("_blk").agg(*[F.sum(v).alias(f"_bt_{v}") for v in value_cols])
    outer = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    offsets = totals.select("_blk", *[F.coalesce(F.sum(f"_bt_{v}").over(outer), F.lit(0)).alias(f"_off_{v}")
                                      for v in value_cols])
    out = df.join(offsets, "_blk", "left")
    for v in value_cols:
        total = F.sum(v).over(inner) + F.col(f"_off_{v}")
        out = out.withColumn(f"total_{v}", total.cast("bigint"))
        out = out.withColumn(f"prev_total_{v}", (F.col(f"total_{v}") - F.col(v)).cast("bigint"))
    return out.drop("_blk", *[f"_off_{v}" for v in value_cols])


def counts_over_time(run_log: DataFrame) -> DataFrame:
    """Per batch: cumulative events and orders, and whether the order count kept growing."""
    cum = running_totals(run_log.select("batch_id", "rows_in", "inserted"), "batch_id", ["rows_in", "inserted"])
    return cum.select(
        "batch_id", "rows_in", "inserted",
        F.col("total_rows_in").alias("total_events"), F.col("total_inserted").alias("total_orders"),
        F.coalesce(F.col("total_inserted") >= F.col("prev_total_inserted"), F.lit(True)).alias("orders_grew"))
