"""The matrix of status transitions, maintained batch by batch, late events included.

The history is kept by order bucket (``history/bucket=<b>/batch_id=<n>``) and the matrix as one small table a
batch (``matrix/batch_id=<n>``: from_status, to_status, n). A batch reads the buckets that its orders are in, and
of those the orders of the batch. Each event is spliced into its order's sequence: a run of new events
between two old ones retracts the old pair and adds the pairs along the run. Predecessors come from the
skew-safe ``with_previous`` (range partitions), so a hot order is spread over tasks.

Sequence order: status_ts, event_id (nulls first), then arrival. A batch that is given again replaces its own
history and matrix, worked out from the batches before it; batches come in order of their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.operators.sequence import with_previous
from orderpulse.operators.validate import transition_class
from orderpulse.session import delete_path, list_names

HISTORY_SCHEMA = "order_id bigint, status_ts timestamp_ntz, event_id string, new_status string, batch_id bigint"
MATRIX_SCHEMA = "from_status string, to_status string, n bigint"
BUCKETS = 64
_ORDER = ["status_ts", "event_id"]


def spliced_pairs(old: DataFrame, new: DataFrame) -> DataFrame:
    """(from_status, to_status, n): pairs added (+1) and retracted (-1) when ``new`` events join the ``old`` ones
    of the same orders; both (order_id, status_ts, event_id, new_status)."""
    before = with_previous(old, "order_id", _ORDER, ["new_status"])
    none = F.lit(None).cast("string")
    rows = before.select("order_id", *_ORDER, "new_status", F.lit(0).alias("came"), F.col("prev_new_status").alias("old_from"),
                         F.col("has_prev").alias("had")).unionByName(
        new.select("order_id", *_ORDER, "new_status", F.lit(1).alias("came"), none.alias("old_from"), F.lit(False).alias("had")))
    rows = rows.withColumn("is_new", F.col("came") == 1)
    now = with_previous(rows, "order_id", [*_ORDER, "came"], ["new_status", "is_new"]).where("has_prev and (is_new or prev_is_new)")
    added = now.select(F.col("prev_new_status").alias("from_status"), F.col("new_status").alias("to_status"), F.lit(1).cast("bigint").alias("n"))
    gone = now.where("not is_new and had").select(F.col("old_from").alias("from_status"), F.col("new_status").alias("to_status"),
                                                  F.lit(-1).cast("bigint").alias("n"))
    return added.unionByName(gone)


class TransitionMatrix:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        """``buckets`` is fixed for the life of the folder."""
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def _bucket(self):
        return F.pmod(F.xxhash64("order_id"), F.lit(self.buckets)).cast("int")

    def _matrix(self, batch_id: int) -> str:
        return f"{self.root}/matrix/batch_id={int(batch_id)}"

    def batches(self) -> list[int]:
        """Batches that the matrix holds: a matrix counts when it is whole."""
        names = [n for n in list_names(self.spark, f"{self.root}/matrix") if n.startswith("batch_id=")]
        return sorted(int(n.split("=")[1]) for n in names if "_SUCCESS" in list_names(self.spark, f"{self.root}/matrix/{n}"))

    def history(self, buckets: list[int], before: int) -> DataFrame:
        """Events of some buckets that came with batches before ``before``; only their folders are listed and read."""
        have = set(list_names(self.spark, f"{self.root}/history"))
        paths = [f"{self.root}/history/bucket={b}" for b in buckets if f"bucket={b}" in have]
        if not paths:
            return self.spark.createDataFrame([], HISTORY_SCHEMA).drop("batch_id")
        rows = self.spark.read.option("basePath", f"{self.root}/history").schema(HISTORY_SCHEMA).parquet(*paths)
        return rows.where(F.col("batch_id") < F.lit(int(before))).drop("batch_id", "bucket")

    def touched(self, new: DataFrame) -> list[int]:
        """Buckets of the batch's orders: at most all."""
        return sorted(r["b"] for r in new.select(self._bucket().alias("b")).distinct().collect())

    def add(self, events: DataFrame, batch_id: int) -> None:
        """Fold one batch of events (order_id, status_ts, event_id, new_status) into the matrix."""
        done = [b for b in self.batches() if b < batch_id]
        new = events.select("order_id", *_ORDER, "new_status")
        # the batch lies in the history first; a batch that fails after that is replaced when it comes again
        (new.withColumns({"bucket": self._bucket(), "batch_id": F.lit(int(batch_id)).cast("bigint")})
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch_id")
         .parquet(f"{self.root}/history"))
        old = self.history(self.touched(new), batch_id)
        orders = new.select(F.col("order_id").alias("o")).distinct()
        old = old.join(orders, F.col("order_id").eqNullSafe(F.col("o")), "left_semi")
        parts = spliced_pairs(old, new)
        if done:
            parts = parts.unionByName(self.spark.read.schema(MATRIX_SCHEMA).parquet(self._matrix(done[-1])))
        counts = parts.groupBy("from_status", "to_status").agg(F.sum("n").alias("n")).where("n <> 0")
        counts.coalesce(1).write.mode("overwrite").parquet(self._matrix(batch_id))
        for b in done[:-1]:  # the one before stays: this batch may come again
            delete_path(self.spark, self._matrix(b))

    def read(self) -> DataFrame:
        """from_status, to_status, n, transition -- as ``validate.status_transitions`` over all events."""
        done = self.batches()
        rows = (self.spark.read.schema(MATRIX_SCHEMA).parquet(self._matrix(done[-1])) if done
                else self.spark.createDataFrame([], MATRIX_SCHEMA))
        return rows.withColumn("transition", transition_class(F.col("from_status"), F.col("to_status")))
