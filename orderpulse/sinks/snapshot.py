"""Per-order state in plain parquet folders; a merge rewrites only the buckets it touches.

Layout under ``root``::

    state/v=<N>/bucket=<b>/part-*     rows of bucket b as rewritten by merge N, each with what the
                                      merge did to it and its status and time before (the change feed)
    _commits/block=<B>/commit-<N>.json   one row: version, batch_id, source_id, run counters, and
                                      ``manifest``: the version that holds each bucket;
                                      B = N // 1000, so finding the latest commit lists
                                      block folders and reads one block

``bucket`` is a hash of ``order_id``. A merge finds the buckets of the reduced batch (at most
the bucket count), reads those alone, joins, and writes them as version N; the other
buckets stay where they are. The bucket count is fixed when the store is created and
recorded in every commit. Reading needs no DDL and no catalog: the manifest names the folders.

A version becomes visible only when its commit row exists, and the commit row is
written after the state files, so readers never see a half-written version. A retry
overwrites the leftover of a failed attempt. Bucket versions that the newest ``keep``
commits no longer name are deleted after each commit.

Idempotent replay: the commit records (source_id, batch_id); ``source_id`` holds the
streaming query's id, so a query with another checkpoint is refused instead of being
taken for a replay.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderpulse.operators.upsert import INSERT, UPDATE, empty_state
from orderpulse.schemas import STATE_SCHEMA, STATUS_COLUMNS
from orderpulse.session import delete_path, list_names, path_exists, read_small_file, write_small_file

COMMIT_SCHEMA = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("source_id", T.StringType()),
    T.StructField("mode", T.StringType()),
    T.StructField("rows_in", T.LongType()),
    T.StructField("rows_bad", T.LongType()),
    T.StructField("inserted", T.LongType()),
    T.StructField("updated", T.LongType()),
    T.StructField("unchanged", T.LongType()),
    T.StructField("max_status_ts", T.StringType()),
    T.StructField("buckets", T.IntegerType()),
    T.StructField("manifest", T.ArrayType(T.LongType())),
    T.StructField("replaced", T.ArrayType(T.StringType())),
    T.StructField("unsettled", T.ArrayType(T.IntegerType())),
    T.StructField("landed_to", T.LongType()),
])

#: One row per order that a merge inserted or updated, as it was before (nulls for an insert) and after.
CHANGE_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("action", T.StringType()),
    T.StructField("pre_status", T.StringType()),
    T.StructField("pre_ts", T.TimestampNTZType()),
    T.StructField("current_status", T.StringType()),
    T.StructField("last_update_ts", T.TimestampNTZType()),
])

COMMITS_PER_BLOCK = 1000
KEEP = 10


@dataclass
class Commit:
    version: int
    batch_id: int
    source_id: str
    buckets: int | None = None
    manifest: list[int] = field(default_factory=list)
    #: buckets with rows that the next merge changes even without new events (see ``unsettled_row``)
    unsettled: list[int] = field(default_factory=list)
    #: newest landed batch whose bad messages are counted
    landed_to: int | None = None


def default_buckets(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def unsettled_row() -> Column:
    """A full rescan merges every stored order again. That changes nothing but a previous status
    whose current status and time are both null: the guards are then true once more."""
    return (F.col("current_status").isNull() & F.col("last_update_ts").isNull()
            & F.col("previous_status").isNotNull())


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self._buckets = buckets

    def buckets(self, commit: Commit | None = None) -> int:
        """Bucket count: the store's recorded one, else the configured/default one."""
        c = commit if commit is not None else self.latest_commit()
        if c is not None and c.buckets:
            return c.buckets
        return self._buckets or default_buckets(self.spark)

    @staticmethod
    def bucket_of(buckets: int) -> Column:
        return F.pmod(F.xxhash64("order_id"), F.lit(buckets)).cast("int")

    def _commits_path(self) -> str:
        return f"{self.root}/_commits"

    def _commit_file(self, version: int) -> str:
        return f"{self._commits_path()}/block={version // COMMITS_PER_BLOCK:010d}/commit-{version:020d}.json"

    def state_path(self, version: int) -> str:
        return f"{self.root}/state/v={int(version)}"

    def commits(self) -> DataFrame:
        """The whole commit log (for the run log)."""
        if not path_exists(self.spark, self._commits_path()):
            return self.spark.createDataFrame([], COMMIT_SCHEMA)
        return self.spark.read.schema(COMMIT_SCHEMA).json(f"{self._commits_path()}/block=*")

    def latest_commit(self) -> Commit | None:
        blocks = sorted(n for n in list_names(self.spark, self._commits_path()) if n.startswith("block="))
        if not blocks:
            return None
        names = sorted(n for n in list_names(self.spark, f"{self._commits_path()}/{blocks[-1]}") if n.startswith("commit-"))
        return self.commit(int(names[-1][len("commit-"):-len(".json")])) if names else None

    def commit(self, version: int) -> Commit:
        r = self._record(version)
        return Commit(r["version"], r["batch_id"], r["source_id"], r["buckets"], list(r["manifest"]), list(r["unsettled"]), r["landed_to"])

    def _record(self, version: int) -> dict:
        return {"landed_to": None, **json.loads(read_small_file(self.spark, self._commit_file(version)))}

    def read_state(self, version: int | None = None, commit: Commit | None = None,
                   only: list[int] | None = None) -> DataFrame:
        """State of ``version`` (default: the latest committed; ``commit`` if already looked up),
        all buckets or ``only`` some."""
        c = commit or (self.latest_commit() if version is None else self.commit(version))
        if c is None:
            return empty_state(self.spark)
        wanted = range(len(c.manifest)) if only is None else only
        paths = [f"{self.state_path(c.manifest[b])}/bucket={b}" for b in wanted if c.manifest[b] >= 0]
        if not paths:
            return empty_state(self.spark)
        return self.spark.read.schema(STATE_SCHEMA).parquet(*paths).select(*STATE_SCHEMA.names)

    def changes(self, version: int) -> DataFrame:
        """The orders that merge ``version`` inserted or updated. Written with the state, so it reads the
        buckets that the merge rewrote and no others; there until ``keep`` newer commits have been made."""
        if not any(n.startswith("bucket=") for n in list_names(self.spark, self.state_path(version))):
            return self.spark.createDataFrame([], CHANGE_SCHEMA)
        rows = self.spark.read.schema(CHANGE_SCHEMA).parquet(self.state_path(version))
        return rows.where(F.col("action").isin(INSERT, UPDATE)).select(*CHANGE_SCHEMA.names)

    def read_status(self, version: int | None = None) -> DataFrame:
        return self.read_state(version).select(*STATUS_COLUMNS)

    @staticmethod
    def is_committed(c: Commit | None, source_id: str, batch_id: int) -> bool:
        return c is not None and c.source_id == source_id and c.batch_id >= batch_id

    def touched(self, source: DataFrame, base: Commit | None) -> list[int]:
        """Buckets that a merge of ``source`` (one row per order) must rewrite: at most all."""
        n = self.buckets(base)
        rows = source.select(self.bucket_of(n).alias("b")).distinct().collect()
        return sorted({r["b"] for r in rows} | set(base.unsettled if base else ()))

    def write_version(self, state_with_action: DataFrame, batch_id: int, source_id: str, mode: str,
                      rows_in: int, rows_bad: int, max_status_ts, base: Commit | None = None,
                      touched: list[int] | None = None, keep: int = KEEP, landed_to: int | None = None) -> Commit:
        """Write the touched buckets (default: all) as the version after ``base`` (the commit they
        were derived from), commit, and delete what the newest ``keep`` commits no longer name."""
        c = base if base is not None else self.latest_commit()
        version = 0 if c is None else c.version + 1
        buckets = self.buckets(c)
        old = c.manifest if c is not None else [-1] * buckets
        touched = list(range(buckets)) if touched is None else touched
        # Action counters are observed while the state is written: no second pass.
        obs = Observation(f"merge_{uuid.uuid4().hex[:12]}_v{version}")
        act = F.col("_action")
        bucket = self.bucket_of(buckets)
        rows = state_with_action.withColumn("bucket", bucket).observe(
            obs, *[F.count(F.when(act == a, F.lit(1))).alias(a) for a in ("insert", "update", "unchanged")],
            F.count(F.when(unsettled_row(), F.lit(1))).alias("unsettled"))
        feed = {"_action": "action", "_pre_status": "pre_status", "_pre_ts": "pre_ts"}
        (rows.withColumnsRenamed(feed).repartition(min(buckets, max(len(touched), 1)), "bucket").write.mode("overwrite")
         .partitionBy("bucket").parquet(self.state_path(version)))
        seen = obs.get
        written = {int(n.split("=")[1]) for n in list_names(self.spark, self.state_path(version)) if n.startswith("bucket=")}
        unsettled = sorted(set(c.unsettled if c else ()) - set(touched))
        if seen["unsettled"]:
            rows = self.spark.read.schema(STATE_SCHEMA).parquet(self.state_path(version)).where(unsettled_row())
            unsettled += [r["b"] for r in rows.select(bucket.alias("b")).distinct().collect()]
        manifest = [version if b in written else -1 if b in set(touched) else old[b] for b in range(buckets)]
        replaced = [f"{old[b]}/{b}" for b in touched if old[b] >= 0]
        row = (version, int(batch_id), source_id, mode, int(rows_in), int(rows_bad),
               int(seen["insert"]), int(seen["update"]), int(seen["unchanged"]),
               None if max_status_ts is None else str(max_status_ts), int(buckets), manifest, replaced,
               sorted(unsettled), landed_to)
        record = json.dumps(dict(zip(COMMIT_SCHEMA.names, row)))
        write_small_file(self.spark, self._commit_file(version), record + "\n")
        self.retain(keep, version)
        return Commit(version, int(batch_id), source_id, buckets, manifest, row[-2], landed_to)

    def retain(self, keep: int = KEEP, version: int | None = None) -> list[str]:
        """Delete the bucket versions that commit ``version - keep + 1`` replaced (the newest ``keep``
        commits stay readable). Called after every commit, so each replaced folder is deleted once.
        The commit log is kept whole (it is the run history)."""
        if version is None:
            c = self.latest_commit()
            if c is None:
                return []
            version = c.version
        out = version - max(int(keep), 1) + 1
        if out <= 0:
            return []
        gone = []
        for name in self._record(out)["replaced"] or ():
            v, b = name.split("/")
            if delete_path(self.spark, f"{self.state_path(int(v))}/bucket={b}"):
                gone.append(name)
        return gone

    def run_log(self) -> DataFrame:
        """One row per committed merge (latest commit per batch and source)."""
        return self.commits().select(
            "batch_id", "rows_in", "rows_bad", "inserted", "updated", "unchanged",
            F.col("max_status_ts").cast("timestamp_ntz").alias("max_status_ts"), "version", "source_id")
