"""Topic -> raw table -> current status, as Structured Streaming queries.

Shape (a), one query: ``foreachBatch`` lands the micro-batch in the raw table
(partition ``batch_id``, overwritten on replay), quarantines bad messages, then
merges into the bucketed state (skipped if this batch is already committed).

Shape (b), two queries, the default for a topic (``start_pipeline``): one lands and
quarantines on every flush; the other streams the raw folder on the merge schedule and
merges each new slice, so the state is rewritten every few minutes and not on every flush.

Offsets are committed by Spark only after ``foreachBatch`` returns, so a crash
replays the batch, and all writes are idempotent under replay. A store belongs to one
streaming query, and so do a raw and a quarantine folder (``sinks/landing.py``), known by the id in
its checkpoint: a query whose checkpoint was lost or replaced is refused before it writes
anything, because its batch numbers start anew.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from dataclasses import dataclass

from orderpulse.functions.scalars import truncate_ts
from orderpulse.operators.upsert import full_state, latest_source, merge_latest
from orderpulse.schemas import EVENT_SCHEMA
from orderpulse.session import path_exists, read_small_file
from orderpulse.sinks.landing import Landed, LandingLog
from orderpulse.sinks.raw import RAW_SCHEMA, land_batch, read_batch, read_batches, read_raw
from orderpulse.sinks.seen import SeenIds
from orderpulse.sinks.snapshot import Commit, SnapshotStore
from orderpulse.sources.messages import decode_messages, split_quarantine
from orderpulse.streaming.sources import with_trigger

QUARANTINE_SCHEMA = "reason string, value string"
#: Arrival time within which a repeated event id is taken for a redelivery.
DEDUPE_WITHIN = "1 day"


@dataclass(frozen=True)
class PipelinePaths:
    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def store(self) -> str:
        return f"{self.root}/store"

    @property
    def seen(self) -> str:
        return f"{self.root}/seen"

    def log(self, spark: SparkSession) -> LandingLog:
        return LandingLog(spark, self.root, self.raw, self.quarantine)

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/_checkpoint/land_merge"

    @property
    def landing_checkpoint(self) -> str:
        return f"{self.root}/_checkpoint/raw_landing"

    @property
    def refresh_checkpoint(self) -> str:
        return f"{self.root}/_checkpoint/refresh"


def _prepare(good: DataFrame, ts_grain: str | None) -> DataFrame:
    return good.withColumn("status_ts", truncate_ts(F.col("status_ts"), ts_grain)) if ts_grain else good


def decoded_stream(messages: DataFrame, dedupe: bool | str = False) -> DataFrame:
    """Decoded messages; with ``dedupe`` good ones without redeliveries of an event id across
    micro-batches. The watermark runs on arrival time, so a late event is never dropped. (``"history"``: no
    state here, the landing holds each batch against all batches before.)"""
    decoded = decode_messages(messages)
    if not dedupe or dedupe == "history":
        return decoded
    # one branch: bad rows pass under keys of their own
    key = F.when(F.col("_bad").isNull(), F.concat(F.lit("id:"), "event_id")).otherwise(F.concat(F.lit("bad:"), F.uuid()))
    return (decoded.withColumns({"_arrived": F.current_timestamp(), "_key": key}).withWatermark("_arrived", DEDUPE_WITHIN)
            .dropDuplicatesWithinWatermark(["_key"]).drop("_arrived", "_key"))


def query_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id of the streaming query that owns the checkpoint."""
    text = read_small_file(spark, f"{checkpoint}/metadata")
    return json.loads(text)["id"] if text else None


def check_owner(spark: SparkSession, store_root: str, checkpoint: str) -> None:
    c = SnapshotStore(spark, store_root).latest_commit()
    if c is not None and c.source_id != query_id(spark, checkpoint):
        raise ValueError(f"store {store_root} belongs to query {c.source_id}, which has not the checkpoint {checkpoint}; "
                         "one writer per target, and a lost checkpoint needs a new store")


def merge_batch(store: SnapshotStore, delta: DataFrame, batch_id: int, source_id: str, mode: str, rows_in: int,
                rows_bad: int, max_status_ts, all_events: DataFrame | None = None, base: Commit | None = None,
                touched_batches=None, landed_to: int | None = None) -> Commit | None:
    """Merge one batch of events into the store; returns the new commit (None if skipped).

    ``incremental`` reduces the batch to one row per order, and reads and rewrites only the buckets
    that those orders are in. ``full`` rescans ``all_events``, as the reference's MERGE does.
    ``base`` is the store's latest commit when the caller already knows it.
    """
    base = base if base is not None else store.latest_commit()
    if store.is_committed(base, source_id, batch_id):
        return None
    if mode == "incremental":
        source = latest_source(delta).persist()
        try:
            touched = store.touched(source, base)
            new = merge_latest(store.read_state(commit=base, only=touched) if base else store.read_state(), source, True)
            return store.write_version(new, batch_id, source_id, mode, rows_in, rows_bad, max_status_ts, base, touched,
                                       landed_to=landed_to)
        finally:
            source.unpersist()
    if mode != "full":
        raise ValueError(f"unknown mode {mode!r}")
    mark = F.col("batch_id") == F.lit(batch_id) if touched_batches is None else touched_batches
    new = full_state(store.read_state(commit=base) if base else store.read_state(), all_events, with_action=True, touched=mark)
    return store.write_version(new, batch_id, source_id, mode, rows_in, rows_bad, max_status_ts, base, landed_to=landed_to)


def land(decoded: DataFrame, paths: PipelinePaths, batch_id: int, source_id: str, ts_grain: str | None = None,
         mark: bool = False, history: bool = False) -> Landed:
    """Land the good rows of a micro-batch and quarantine the others, text and all, then put the batch on
    the landing log. A half that is empty writes nothing; with ``mark`` a batch of bad messages alone
    leaves an empty raw partition, so that a merge that follows the raw folder hears of it. With ``history``
    events whose ids any batch before has landed are left out."""
    log = paths.log(decoded.sparkSession)
    log.claim(source_id)
    ok = F.col("_bad").isNull()
    good, bad = split_quarantine(decoded)
    good = _prepare(good, ts_grain)
    ts = truncate_ts(F.col("status_ts"), ts_grain) if ts_grain else F.col("status_ts")
    n = decoded.agg(F.count(F.when(ok, F.lit(1))).alias("good"), F.count(F.when(~ok, F.lit(1))).alias("bad"),
                    F.max(F.when(ok, ts)).cast("string").alias("mx")).first()
    if history and n["good"]:
        seen = SeenIds(decoded.sparkSession, paths.seen)
        good = seen.unseen(good, batch_id).persist()
        kept = good.agg(F.count(F.lit(1)).alias("good"), F.max("status_ts").cast("string").alias("mx")).first()
        landed = Landed(int(batch_id), kept["good"], n["bad"], kept["mx"])
    else:
        landed = Landed(int(batch_id), n["good"], n["bad"], n["mx"])
    if landed.good + landed.bad == 0:
        return landed
    if landed.bad:
        bad.write.mode("overwrite").json(f"{paths.quarantine}/batch_id={int(batch_id)}")
    if landed.good or mark:
        land_batch(good.select(*EVENT_SCHEMA.names), paths.raw, batch_id)
    if history and n["good"]:
        good.unpersist()
        if landed.good:
            seen.add(read_batch(decoded.sparkSession, paths.raw, batch_id), batch_id)
    log.record(landed)
    return landed


def bad_rows(log: LandingLog, base: Commit | None) -> tuple[int, int | None]:
    """(bad messages of the landed batches that no commit has counted, the newest landed batch)."""
    counted = base.landed_to if base is not None else None
    news = log.after(-1 if counted is None else counted)
    return sum(n.bad for n in news), news[-1].batch_id if news else counted


class LandAndMerge:
    """The ``foreachBatch`` body of shape (a): land good rows (partition ``batch_id``), quarantine
    bad ones, merge, commit."""

    def __init__(self, paths: PipelinePaths, mode: str = "incremental", ts_grain: str | None = None):
        self.paths, self.mode, self.ts_grain = paths, mode, ts_grain
        self._last: Commit | None = None  # this query is the store's only writer

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        store = SnapshotStore(spark, self.paths.store)
        source_id = query_id(spark, self.paths.checkpoint) or self.paths.checkpoint
        if self._last is None:
            self._last = store.latest_commit()
        if store.is_committed(self._last, source_id, batch_id):
            return  # replay of a batch merged before a restart
        decoded = batch.persist()
        try:
            n = land(decoded, self.paths, batch_id, source_id, self.ts_grain)
            if n.good + n.bad == 0:
                return
            delta = read_batch(spark, self.paths.raw, batch_id) if n.good else spark.createDataFrame([], RAW_SCHEMA)
            all_events = None
            if self.mode == "full":
                all_events = read_raw(spark, self.paths.raw) if path_exists(spark, self.paths.raw) else delta
            commit = merge_batch(store, delta, batch_id, source_id, self.mode, n.good, n.bad, n.max_status_ts, all_events,
                                 self._last, landed_to=n.batch_id)
            if commit is not None:
                self._last = commit
        finally:
            decoded.unpersist()


def start_land_merge(messages: DataFrame, paths: PipelinePaths, mode: str = "incremental",
                     trigger: str = "flush", ts_grain: str | None = None,
                     dedupe: bool = False) -> StreamingQuery:
    spark = messages.sparkSession
    check_owner(spark, paths.store, paths.checkpoint)
    paths.log(spark).check(query_id(spark, paths.checkpoint))
    writer = (decoded_stream(messages, dedupe).writeStream.foreachBatch(LandAndMerge(paths, mode, ts_grain))
              .option("checkpointLocation", paths.checkpoint))
    return with_trigger(writer, trigger).start()


def start_raw_landing(messages: DataFrame, paths: PipelinePaths, trigger: str = "flush",
                      dedupe: bool | str = False, ts_grain: str | None = None, name: str | None = None) -> StreamingQuery:
    """Shape (b), query A: good messages to the raw folder, the others to quarantine. ``dedupe``: True for
    redeliveries within a day (in Spark's state), ``"history"`` for those of any age (``sinks/seen.py``)."""
    spark = messages.sparkSession
    paths.log(spark).check(query_id(spark, paths.landing_checkpoint))

    def sink(batch: DataFrame, batch_id: int) -> None:
        decoded = batch.persist()
        try:
            land(decoded, paths, batch_id, query_id(batch.sparkSession, paths.landing_checkpoint), ts_grain, mark=True,
                 history=dedupe == "history")
        finally:
            decoded.unpersist()

    writer = (decoded_stream(messages, dedupe).writeStream.foreachBatch(sink)
              .option("checkpointLocation", paths.landing_checkpoint))
    if name:
        writer = writer.queryName(name)
    return with_trigger(writer, trigger).start()


def raw_stream(spark: SparkSession, paths: PipelinePaths) -> DataFrame:
    """The raw folder as an append-only change stream. A landing batch that is written again after a
    failure shows again; merging the same events twice changes nothing."""
    return spark.readStream.schema(RAW_SCHEMA).parquet(paths.raw)


def quarantined(spark: SparkSession, paths: PipelinePaths) -> DataFrame:
    """Every quarantined message: reason, value (its text), batch_id."""
    if not path_exists(spark, paths.quarantine):
        return spark.createDataFrame([], QUARANTINE_SCHEMA + ", batch_id bigint")
    return spark.read.schema(QUARANTINE_SCHEMA + ", batch_id bigint").json(paths.quarantine)


def start_refresh(spark: SparkSession, paths: PipelinePaths, trigger: str = "schedule") -> StreamingQuery:
    """Shape (b), query B: each new slice of the raw folder is merged incrementally. The bad messages of
    all batches on the landing log that no commit has counted yet are counted with it; a batch of bad
    messages alone makes a commit without rows."""
    check_owner(spark, paths.store, paths.refresh_checkpoint)

    def merge(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        store = SnapshotStore(session, paths.store)
        source_id = query_id(session, paths.refresh_checkpoint)
        base = store.latest_commit()
        if store.is_committed(base, source_id, batch_id):
            return
        rows = batch.persist()
        try:
            seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max("status_ts").alias("mx")).first()
            bad, landed_to = bad_rows(paths.log(session), base)
            if seen["n"] + bad:
                merge_batch(store, rows, batch_id, source_id, "incremental", seen["n"], bad, seen["mx"], base=base,
                            landed_to=landed_to)
        finally:
            rows.unpersist()

    writer = (raw_stream(spark, paths).writeStream.foreachBatch(merge)
              .option("checkpointLocation", paths.refresh_checkpoint))
    return with_trigger(writer, trigger).start()


def start_pipeline(messages: DataFrame, paths: PipelinePaths, dedupe: bool | str = False, ts_grain: str | None = None,
                   landing_trigger: str = "arrival") -> list[StreamingQuery]:
    """The pipeline of a topic: land whenever the source has a batch (its options hold the flush size and
    delay; for files use the ``flush`` trigger), merge on the schedule."""
    landing = start_raw_landing(messages, paths, landing_trigger, dedupe, ts_grain)
    spark = messages.sparkSession
    if not path_exists(spark, paths.raw):  # the change stream needs its folder
        spark.createDataFrame([], EVENT_SCHEMA).write.mode("ignore").parquet(f"{paths.raw}/batch_id=-1")
    return [landing, start_refresh(spark, paths, "schedule")]


def run_to_completion(query: StreamingQuery, timeout_s: int | None = None) -> None:
    """Wait for an ``availableNow`` query to finish, as long as it takes (a caller may set a
    limit); raise its error if it failed."""
    query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    if query.isActive:
        query.stop()
        raise TimeoutError(f"streaming query {query.id} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def query_status(spark: SparkSession) -> DataFrame:
    """Active streaming queries and their last progress (the task list)."""
    rows = []
    for q in spark.streams.active:
        p = q.lastProgress or {}
        rows.append((str(q.id), q.name, q.status.get("message"), p.get("batchId"),
                     p.get("numInputRows"), p.get("timestamp")))
    return spark.createDataFrame(rows, "id string, name string, message string, batch_id long, "
                                       "input_rows long, last_progress string")


def land_all(events: DataFrame, paths: PipelinePaths, batch_col: str = "batch_id") -> None:
    """Bulk-land already-batched events into the raw table (one partition per batch),
    replacing exactly the partitions present (dynamic partition overwrite).

    No shuffle before the write: every input task writes its own rows of each
    batch, so a hot order or batch never funnels into one writer."""
    (events.select(*EVENT_SCHEMA.names, F.col(batch_col).cast("bigint").alias("batch_id"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(paths.raw))


def refresh(spark: SparkSession, paths: PipelinePaths, mode: str = "incremental",
            up_to_batch: int | None = None, source_id: str = "refresh") -> Commit | None:
    """The scheduled merge as a batch job (also the initial load).

    Merges the raw batches landed after the store's last committed batch (up to
    ``up_to_batch``) in one merge; what a stream has landed is taken from its landing log, bad messages
    counted. ``incremental`` reads only those partitions and rewrites
    only the buckets that their orders are in; ``full`` rescans the whole raw
    table, as the reference's scheduled MERGE does. Re-running with nothing new
    is a no-op.
    """
    store = SnapshotStore(spark, paths.store)
    base = store.latest_commit()
    if base is not None and base.source_id != source_id:
        raise ValueError(f"store {paths.store} is owned by {base.source_id}; one writer per target")
    after = -1 if base is None else base.batch_id
    mark = F.col("batch_id") > F.lit(after)
    news = paths.log(spark).after(after, up_to_batch)
    if news:  # landed by a stream: the log tells folders, counts and times, so the batch is read once
        good = [n for n in news if n.good]
        pending = read_batches(spark, paths.raw, [n.batch_id for n in good])
        rows, last, newest = sum(n.good for n in good), news[-1].batch_id, max((n.max_status_ts for n in good if n.max_status_ts), default=None)
    else:  # landed in bulk
        pending = read_raw(spark, paths.raw).where(mark)
        if up_to_batch is not None:
            pending = pending.where(F.col("batch_id") <= up_to_batch)
        rows, newest, last = pending.agg(F.count(F.lit(1)), F.max("status_ts"), F.max("batch_id")).first()
        if not rows:
            return None
    seen = read_raw(spark, paths.raw).where(F.col("batch_id") <= last) if mode == "full" else None
    return merge_batch(store, pending, last, source_id, mode, rows, sum(n.bad for n in news), newest, seen, base, mark,
                       landed_to=last)
