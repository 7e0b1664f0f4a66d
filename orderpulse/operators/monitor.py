"""Monitoring queries: recent-status slice, dashboard metrics, filtered views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse.functions.scalars import display_ts
from orderpulse.operators.joins import combine_one_row

SLICE_ROWS = 1000
SLICE_COLUMNS = ["order_id", "customer_id", "current_status", "previous_status", "last_update_ts"]


def recent_status(status: DataFrame, n: int = SLICE_ROWS) -> DataFrame:
    """Top-n by last_update_ts desc (nulls last), order_id as tie-break: TakeOrderedAndProject."""
    return status.select(*SLICE_COLUMNS).orderBy(
        F.col("last_update_ts").desc_nulls_last(), F.col("order_id").asc_nulls_last()).limit(n)


def event_stats(events: DataFrame, approx_rsd: float | None = None) -> DataFrame:
    """total_events, unique_orders, latest_event in one pass over the events.

    ``approx_rsd`` switches unique_orders to ``approx_count_distinct`` (HyperLogLog++,
    fixed-size sketches instead of a shuffle of every distinct id) for very large tables.
    """
    unique = (F.countDistinct("order_id") if approx_rsd is None
              else F.approx_count_distinct("order_id", approx_rsd))
    return events.agg(F.count(F.lit(1)).alias("total_events"), unique.alias("unique_orders"),
                      F.max("status_ts").alias("latest_event"))


def dashboard_metrics(status: DataFrame, events: DataFrame, n: int = SLICE_ROWS,
                      approx_rsd: float | None = None) -> DataFrame:
    """One row: tracked_orders and latest_update over the top-n slice (as displayed),
    plus the event statistics over the whole raw table, and full-table counterparts."""
    slice_ = recent_status(status, n)
    sl = slice_.agg(F.countDistinct("order_id").alias("tracked_orders"),
                    F.max("last_update_ts").alias("_latest_update"))
    full = status.agg(F.countDistinct("order_id").alias("tracked_orders_full"))
    row = combine_one_row(sl, event_stats(events, approx_rsd), full)  # each input computed once
    return row.select(
        "tracked_orders",
        F.coalesce(display_ts(F.col("_latest_update")), F.lit("N/A")).alias("latest_update"),
        "total_events", "unique_orders", "latest_event", "tracked_orders_full")


def status_counts_slice(status: DataFrame, n: int = SLICE_ROWS) -> DataFrame:
    """value_counts() of current_status over the top-n slice: nulls dropped, count desc."""
    return (recent_status(status, n).where(F.col("current_status").isNotNull())
            .groupBy("current_status").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), "current_status"))


def filter_status(status: DataFrame, statuses=None, customer_ids=None,
                  since: Column | str | None = None, until: Column | str | None = None) -> DataFrame:
    """Parameterised status view; predicates push down when ``status`` is a scan."""
    cond = F.lit(True)
    if statuses:
        cond = cond & F.col("current_status").isin(list(statuses))
    if customer_ids:
        cond = cond & F.col("customer_id").isin(list(customer_ids))
    if since is not None:
        cond = cond & (F.col("last_update_ts") >= (since if isinstance(since, Column) else F.lit(since).cast("timestamp_ntz")))
    if until is not None:
        cond = cond & (F.col("last_update_ts") < (until if isinstance(until, Column) else F.lit(until).cast("timestamp_ntz")))
    return status.where(cond)
