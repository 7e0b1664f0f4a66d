"""Conditional keyed upsert of the latest event into the current-status table.

    match on order_id
    matched AND newer(S.ts, T.ts) AND changed(T.current, S.new)
        -> previous = T.current, current = S.new, last_update_ts = S.ts, customer_id = S.customer_id
    matched otherwise      -> unchanged
    not matched (source)   -> insert (order_id, S.customer_id, NULL, S.new, S.ts)
    target only            -> unchanged

Plan: one full outer join on ``order_id``. Presence flags (not key-null tests) tell
"no target row" from "target row with null columns". An update guard that
evaluates to NULL falls through to "unchanged", as in MERGE.

Both inputs are one row per order, so the join is 1:1 per key and cannot skew;
the source usually arrives hash-partitioned on ``order_id`` from its aggregate,
so only the target is exchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.functions.predicates import changed, newer
from orderpulse.schemas import STATE_SCHEMA, STATUS_COLUMNS, STATUS_SCHEMA

INSERT, UPDATE, UNCHANGED, KEPT = "insert", "update", "unchanged", "kept"


def empty_status(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATUS_SCHEMA)


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE_SCHEMA)


def merge_columns(t_present: Column, s_present: Column, t: dict, s: dict) -> dict:
    """Output columns of the MERGE for one joined row.

    ``t``: customer_id, previous_status, current_status, last_update_ts of the target.
    ``s``: customer_id, new_status, ts of the source.
    """
    ins = t_present.isNull() & s_present.isNotNull()
    upd = (t_present.isNotNull() & s_present.isNotNull()
           & newer(s["ts"], t["last_update_ts"]) & changed(t["current_status"], s["new_status"]))
    take = ins | upd  # NULL when the guards are NULL -> falls to otherwise()
    return {
        "customer_id": F.when(take, s["customer_id"]).otherwise(t["customer_id"]),
        "previous_status": F.when(ins, F.lit(None).cast("string"))
                            .when(upd, t["current_status"]).otherwise(t["previous_status"]),
        "current_status": F.when(take, s["new_status"]).otherwise(t["current_status"]),
        "last_update_ts": F.when(take, s["ts"]).otherwise(t["last_update_ts"]),
        "_action": (F.when(ins, INSERT).when(upd, UPDATE)
                    .when(s_present.isNotNull(), UNCHANGED).otherwise(KEPT)),
    }


def upsert_status(target: DataFrame, source: DataFrame, with_action: bool = False) -> DataFrame:
    """MERGE ``source`` (order_id, customer_id, new_status, last_event_ts; one row per
    order) into ``target`` (the status table). Null source keys are quarantined:
    ``=`` never matches them, so MERGE would insert a fresh null-key row every run."""
    t = target.select(
        "order_id", F.lit(True).alias("_t"),
        *[F.col(c).alias(f"t_{c}") for c in STATUS_COLUMNS if c != "order_id"])
    s = source.where(F.col("order_id").isNotNull()).select(
        "order_id", F.lit(True).alias("_s"),
        F.col("customer_id").alias("s_customer_id"),
        F.col("new_status").alias("s_new_status"),
        F.col("last_event_ts").alias("s_ts"))
    j = t.join(s, "order_id", "full_outer")
    cols = merge_columns(
        F.col("_t"), F.col("_s"),
        {c: F.col(f"t_{c}") for c in STATUS_COLUMNS if c != "order_id"},
        {"customer_id": F.col("s_customer_id"), "new_status": F.col("s_new_status"), "ts": F.col("s_ts")})
    out = [F.col("order_id")] + [cols[c].alias(c) for c in STATUS_COLUMNS if c != "order_id"]
    if with_action:
        out.append(cols["_action"].alias("_action"))
    return j.select(*out)


def _event_struct(prefix: str) -> Column:
    return F.struct(*[F.col(f"{prefix}{c}").alias(c)
                      for c in ("status_ts", "event_id", "customer_id", "new_status")])


def latest_source(events: DataFrame, touched: Column | None = None) -> DataFrame:
    """Latest event per order as merge source; ``_touched`` marks orders with events
    matching ``touched`` (the current batch), computed in the same aggregate."""
    ev = events.where(F.col("order_id").isNotNull())
    cols = ["status_ts", "event_id", "customer_id", "new_status"]
    aggs = [F.max(F.struct(*[F.col(c) for c in cols])).alias("_l")]
    aggs.append((F.max(touched) if touched is not None else F.lit(True)).alias("_touched"))
    return ev.groupBy("order_id").agg(*aggs).select(
        "order_id", F.lit(True).alias("_s"), F.coalesce(F.col("_touched"), F.lit(False)).alias("_touched"),
        *[F.col(f"_l.{c}").alias(f"d_{c}") for c in cols])


def _merge_state(state: DataFrame, d: DataFrame, incremental: bool, with_action: bool) -> DataFrame:
    j = state.withColumn("_t", F.lit(True)).join(d, "order_id", "full_outer")
    has_le = (F.col("le_event_id").isNotNull() | F.col("le_status_ts").isNotNull()
              | F.col("le_new_status").isNotNull() | F.col("le_customer_id").isNotNull())
    if incremental:
        # Source = latest of (stored latest, batch latest), applied to every stored row.
        le = (F.when(F.col("_s").isNull(), _event_struct("le_"))
              .when(F.col("_t").isNull() | ~has_le, _event_struct("d_"))
              .otherwise(F.greatest(_event_struct("le_"), _event_struct("d_"))))
        s_present = F.when(F.col("_s").isNotNull() | has_le, F.lit(True))
    else:
        # Source = latest over the whole event history, present where it has events.
        le = F.when(F.col("_s").isNotNull(), _event_struct("d_")).otherwise(_event_struct("le_"))
        s_present = F.col("_s")
    j = j.withColumn("_le", le)
    cols = merge_columns(
        F.col("_t"), s_present,
        {c: F.col(c) for c in STATUS_COLUMNS if c != "order_id"},
        {"customer_id": F.col("_le.customer_id"), "new_status": F.col("_le.new_status"),
         "ts": F.col("_le.status_ts")})
    # Actions per merge: insert / update / unchanged (order had events in this batch
    # but the guards held it) / kept (order not in this batch and not updated).
    action = (F.when(cols["_action"].isin(INSERT, UPDATE), cols["_action"])
              .when(F.coalesce(F.col("_touched"), F.lit(False)), UNCHANGED).otherwise(KEPT))
    out = [F.col("order_id")] + [cols[c].alias(c) for c in STATUS_COLUMNS if c != "order_id"] + [
        F.col("_le.event_id").alias("le_event_id"),
        F.col("_le.customer_id").alias("le_customer_id"),
        F.col("_le.new_status").alias("le_new_status"),
        F.col("_le.status_ts").alias("le_status_ts")]
    if with_action:  # and the row as it was before, for the change feed
        out += [action.alias("_action"), F.col("current_status").alias("_pre_status"), F.col("last_update_ts").alias("_pre_ts")]
    return j.select(*out)


def merge_latest(state: DataFrame, source: DataFrame, with_action: bool = False) -> DataFrame:
    """``advance_state`` for a batch that is already reduced (``latest_source``)."""
    return _merge_state(state, source, True, with_action)


def advance_state(state: DataFrame, delta_events: DataFrame, with_action: bool = False) -> DataFrame:
    """Incremental merge: fold a batch of new events into the per-order state.

    ``state`` holds the status columns and the latest event seen so far (``le_*``).
    The merge source of every order is the latest of (stored latest, batch
    latest), which is what a rescan of all events would pick, and the merge is
    re-applied to every stored row as a full rescan does. The result therefore
    equals the full-rescan MERGE for any split of the events into batches, for
    one pass over state + batch instead of the whole event history.
    """
    return _merge_state(state, latest_source(delta_events), True, with_action)


def full_state(state: DataFrame, all_events: DataFrame, with_action: bool = False,
               touched: Column | None = None) -> DataFrame:
    """Full-rescan merge (the reference's behaviour) into the same state layout.

    ``touched`` (e.g. ``batch_id == current``) only feeds the action report.
    """
    return _merge_state(state, latest_source(all_events, touched), False, with_action)


def state_to_status(state: DataFrame) -> DataFrame:
    return state.select(*STATUS_COLUMNS)
