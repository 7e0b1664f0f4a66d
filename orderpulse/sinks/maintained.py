"""Views of the status table that are kept up to date from its change feed and its rewritten buckets.

Each view lives beside the store (``views/<name>/v=<N>``), belongs to commit N, and is advanced after any
number of commits; what it reads grows with the changes, not with the table. A version is written whole
before it counts (its ``_SUCCESS`` file), and written again after a failure. A view that has fallen
further behind than the feed reaches is built anew from the state.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderpulse.operators.monitor import SLICE_COLUMNS, SLICE_ROWS, recent_status
from orderpulse.operators.upsert import INSERT, UPDATE
from orderpulse.schemas import STATUS_SCHEMA
from orderpulse.session import delete_path, list_names
from orderpulse.sinks.snapshot import KEEP, Commit, SnapshotStore


class _View:
    name = ""

    def __init__(self, store: SnapshotStore):
        self.store, self.spark = store, store.spark
        self.root = f"{store.root}/views/{self.name}"

    def path(self, version: int) -> str:
        return f"{self.root}/v={int(version)}"

    def _versions(self) -> list[int]:
        return sorted(int(n[2:]) for n in list_names(self.spark, self.root) if n.startswith("v="))

    def _whole(self, version: int) -> bool:
        return "_SUCCESS" in list_names(self.spark, self.path(version))

    def version(self) -> int | None:
        """The newest commit that the view is up to date with."""
        return next((v for v in reversed(self._versions()) if self._whole(v)), None)


class StatusDistribution(_View):
    """Orders per current status and day of the last update, by retracting and adding: an insert adds one to
    its cell, an update takes one from the cell it left and adds one to the cell it came to."""

    name = "distribution"
    schema = "current_status string, day date, n bigint"

    @staticmethod
    def deltas(changes: DataFrame) -> DataFrame:
        come = changes.select("current_status", F.to_date("last_update_ts").alias("day"), F.lit(1).cast("bigint").alias("n"))
        gone = changes.where(F.col("action") == UPDATE).select(F.col("pre_status").alias("current_status"),
                                                               F.to_date("pre_ts").alias("day"), F.lit(-1).cast("bigint").alias("n"))
        return come.unionByName(gone)

    def pending(self, commit: Commit, done: int | None) -> DataFrame:
        """The old counts and the deltas of the commits since, or the whole state where the feed does not
        reach back so far."""
        if done is None or done < commit.version - KEEP:
            return self.store.read_state(commit=commit).select(
                "current_status", F.to_date("last_update_ts").alias("day"), F.lit(1).cast("bigint").alias("n"))
        feeds = [self.deltas(self.store.changes(v)) for v in range(done + 1, commit.version + 1)]
        return reduce(DataFrame.unionByName, feeds, self.spark.read.schema(self.schema).parquet(self.path(done)))

    def advance(self) -> int | None:
        commit, done = self.store.latest_commit(), self.version()
        if commit is None or done == commit.version:
            return done
        counts = self.pending(commit, done).groupBy("current_status", "day").agg(F.sum("n").alias("n")).where("n <> 0")
        # at most statuses x days rows
        counts.coalesce(1).write.mode("overwrite").parquet(self.path(commit.version))
        for v in self._versions():
            if v not in (done, commit.version):
                delete_path(self.spark, self.path(v))
        return commit.version

    def read(self) -> DataFrame:
        done = self.version()
        if done is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path(done))

    def by_status(self) -> DataFrame:
        """current_status, n -- as ``validate.status_distribution``."""
        return (self.read().groupBy("current_status").agg(F.sum("n").alias("n"))
                .orderBy(F.col("n").desc(), F.col("current_status").asc_nulls_last()))


class RecentHeads(_View):
    """The newest orders of every bucket, taken when the bucket is rewritten: a head of at most ``rows`` a
    bucket, so the newest ``rows`` of the table are among the heads, ties and null times included."""

    name = "recent"

    def __init__(self, store: SnapshotStore, rows: int = SLICE_ROWS):
        super().__init__(store)
        self.rows = rows

    def _heads(self, version: int, buckets: list[int], count: int) -> None:
        paths = [f"{self.store.state_path(version)}/bucket={b}" for b in buckets]
        state = self.spark.read.schema(STATUS_SCHEMA).parquet(*paths).select(*SLICE_COLUMNS)
        newest = W.partitionBy("bucket").orderBy(F.col("last_update_ts").desc_nulls_last(), F.col("order_id").asc_nulls_last())
        # limited in each input task before the exchange (WindowGroupLimit)
        head = (state.withColumn("bucket", self.store.bucket_of(count)).withColumn("_place", F.row_number().over(newest))
                .where(F.col("_place") <= self.rows).drop("_place"))
        head.write.mode("overwrite").partitionBy("bucket").parquet(self.path(version))

    def advance(self) -> int | None:
        """A bucket's head is under the version that wrote the bucket, as the manifest has it."""
        commit = self.store.latest_commit()
        if commit is None:
            return None
        have = {v for v in self._versions() if self._whole(v)}
        for version in sorted(set(commit.manifest) - have - {-1}):
            self._heads(version, [b for b, v in enumerate(commit.manifest) if v == version], commit.buckets)
        for v in self._versions():
            if v not in commit.manifest:
                delete_path(self.spark, self.path(v))
        return commit.version

    def read(self) -> DataFrame:
        """The newest ``rows`` orders, from the heads alone: at most buckets x rows rows."""
        commit = self.store.latest_commit()
        paths = [] if commit is None else [f"{self.path(v)}/bucket={b}" for b, v in enumerate(commit.manifest) if v >= 0]
        if not paths:
            return recent_status(self.spark.createDataFrame([], STATUS_SCHEMA), self.rows)
        return recent_status(self.spark.read.schema(STATUS_SCHEMA).parquet(*paths), self.rows)
