"""Keyed-state variant of the merge: the latest event of every order in Spark's state store.

The landing query of shape (b) lands and quarantines messages; this one streams the raw folder and
keeps, per order, the greatest (status_ts, event_id, customer_id, new_status) seen -- a built-in
streaming aggregate: partial aggregation before the exchange (a hot order is one row per task), state
in Spark's state store, exact values of every type. Each micro-batch emits the orders that it
touched, and these are merged into the buckets of the status store that they are in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderpulse.session import delete_path
from orderpulse.sinks.snapshot import SnapshotStore
from orderpulse.streaming.land_merge import PipelinePaths, bad_rows, check_owner, merge_batch, query_id, raw_stream
from orderpulse.streaming.sources import with_trigger

TOUCHED_SCHEMA = "order_id bigint, status_ts timestamp_ntz, event_id string, customer_id bigint, new_status string"
_EVENT = ["status_ts", "event_id", "customer_id", "new_status"]


def latest_events(events: DataFrame) -> DataFrame:
    """Latest event per order over all events so far (streaming: output mode update)."""
    return (events.where(F.col("order_id").isNotNull()).groupBy("order_id")
            .agg(F.max(F.struct(*_EVENT)).alias("_l")).select("order_id", *[f"_l.{c}" for c in _EVENT]))


def start_stateful_merge(spark: SparkSession, paths: PipelinePaths, trigger: str = "schedule") -> StreamingQuery:
    """raw folder -> latest event per order (state store) -> merge of the touched orders."""
    checkpoint = f"{paths.root}/_checkpoint/stateful"
    check_owner(spark, paths.store, checkpoint)

    def merge(batch: DataFrame, batch_id: int) -> None:
        # the touched orders leave the state store once, into a folder of the batch (replaced on replay)
        path = f"{paths.root}/touched/batch_id={int(batch_id)}"
        batch.write.mode("overwrite").parquet(path)
        session = batch.sparkSession
        rows = session.read.schema(TOUCHED_SCHEMA).parquet(path)
        stats = rows.agg(F.count(F.lit(1)).alias("n"), F.max("status_ts").alias("mx")).first()
        store = SnapshotStore(session, paths.store)
        base = store.latest_commit()
        bad, landed_to = bad_rows(paths.log(session), base)
        if stats["n"] + bad:
            merge_batch(store, rows, batch_id, query_id(session, checkpoint), "incremental", stats["n"], bad, stats["mx"],
                        base=base, landed_to=landed_to)
        delete_path(session, path)

    writer = (latest_events(raw_stream(spark, paths)).writeStream.outputMode("update").foreachBatch(merge)
              .option("checkpointLocation", checkpoint))
    return with_trigger(writer, trigger).start()
