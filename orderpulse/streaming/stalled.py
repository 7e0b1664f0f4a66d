"""Stalled orders: no event for some hours after the last one.

The events of an order that are no further apart than ``quiet`` are one active span, which is Spark's own
session window: the state store holds the open spans of each order, and a span leaves it, as a stall, once the
watermark has passed its last event by ``quiet``. No Python runs per order. An order that goes on
later has a new span, and a new row if it stalls again.

A span says which event was its last, not how many there were, so an event that is delivered twice (a landing
batch that is written again after a failure) changes nothing. Events without an order or a time belong to no
span. Events that come more than ``late_by`` behind the newest one may be dropped, as their span may have left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderpulse.session import path_exists
from orderpulse.streaming.land_merge import PipelinePaths, query_id, raw_stream
from orderpulse.streaming.sources import with_trigger

QUIET = "24 hours"
LATE_BY = "1 hour"
STALL_SCHEMA = ("order_id bigint, active_from timestamp_ntz, status_ts timestamp_ntz, event_id string, customer_id bigint, "
                "new_status string, stalled_at timestamp_ntz")
#: Spans are merged inside a task before the exchange: a hot order is a few rows per task.
_MERGE_FIRST = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def timed(events: DataFrame) -> DataFrame:
    """``events`` with ``_at``, their UTC time as the instant that watermarks ask for, whatever the session's zone."""
    return events.withColumn("_at", F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"),
                                                                        F.col("status_ts"))))


def active_spans(events: DataFrame, quiet: str = QUIET) -> DataFrame:
    """One row per span of ``timed`` events: its order, first time, last event, and the time at which it counts as stalled."""
    known = events.where(F.col("order_id").isNotNull() & F.col("status_ts").isNotNull())
    spans = known.groupBy("order_id", F.session_window("_at", quiet)).agg(
        F.min("status_ts").alias("active_from"), F.max(F.struct("status_ts", "event_id", "customer_id", "new_status")).alias("last"))
    return spans.select("order_id", "active_from", "last.*", (F.col("last.status_ts") + F.expr(f"interval {quiet}")).alias("stalled_at"))


def stalls(events: DataFrame, as_of: Column, quiet: str = QUIET) -> DataFrame:
    """The stalls of a table of events that are past at ``as_of``."""
    return active_spans(timed(events), quiet).where(F.col("stalled_at") <= as_of)


def stalls_path(paths: PipelinePaths) -> str:
    return f"{paths.root}/stalls"


def start_stalls(spark: SparkSession, paths: PipelinePaths, quiet: str = QUIET, late_by: str = LATE_BY,
                 trigger: str = "schedule") -> StreamingQuery:
    """raw folder -> spans that have stalled, each written once (a replayed micro-batch replaces its folder)."""
    checkpoint = f"{paths.root}/_checkpoint/stalls"
    if path_exists(spark, stalls_path(paths)) and query_id(spark, checkpoint) is None:
        raise ValueError(f"{stalls_path(paths)} belongs to a query whose checkpoint {checkpoint} is lost; "
                         "its batches would be written over")

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{stalls_path(paths)}/batch_id={int(batch_id)}")

    before = spark.conf.get(_MERGE_FIRST)
    spark.conf.set(_MERGE_FIRST, "true")  # the stream keeps the settings that it starts with
    try:
        writer = (active_spans(timed(raw_stream(spark, paths)).withWatermark("_at", late_by), quiet).writeStream
                  .outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint))
        return with_trigger(writer, trigger).start()
    finally:
        spark.conf.set(_MERGE_FIRST, before)


def read_stalls(spark: SparkSession, paths: PipelinePaths) -> DataFrame:
    """Every stall so far, with the micro-batch that found it."""
    if not path_exists(spark, stalls_path(paths)):
        return spark.createDataFrame([], STALL_SCHEMA + ", batch_id bigint")
    return spark.read.schema(STALL_SCHEMA + ", batch_id bigint").parquet(stalls_path(paths))
