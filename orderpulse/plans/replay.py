"""Replay a sequence of arrival batches through the merge.

``full``: each merge rescans every event arrived so far (the reference's MERGE).
``incremental``: each merge folds only the new batch into the per-order state.
Both give the same table for any batch split (see ``advance_state``).
``delta_only``: merges the latest of the batch alone; kept to show why state is
needed (it differs when a late event follows an unchanged-status update).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse.operators.latest import latest_per_key, latest_status
from orderpulse.operators.upsert import (merge_columns, advance_state, empty_state, empty_status,
                                         full_state, state_to_status, upsert_status)
from orderpulse.schemas import STATUS_COLUMNS
from orderpulse.session import checkpoint_root

TWO_BATCHES = [[0], [1, 2, 3, 4]]
FIVE_BATCHES = [[0], [1], [2], [3], [4]]


def replay_state(events: DataFrame, batches: Sequence[Sequence[int]], mode: str = "full",
                 batch_col: str = "batch_id", checkpoint_every: int = 0,
                 with_action: bool = False) -> DataFrame:
    """Final per-order state after merging each batch group in turn.

    ``checkpoint_every=k`` writes the state to the shared checkpoint folder every
    k merges, so long replays keep a short lineage (and survive lost executors).
    """
    spark = events.sparkSession
    state = empty_state(spark)
    if len(batches) > 1:
        # Latest-per-order is associative: reduce the events once per (order, batch) and
        # let every merge step read that (much smaller) result. Written as a reliable
        # checkpoint, which also keeps Catalyst from pushing each step's batch filter
        # below the shared aggregate (that would rescan the events per step).
        checkpoint_root(spark)
        events = latest_per_key(events.where(F.col("order_id").isNotNull()),
                                key=["order_id", batch_col]).checkpoint(eager=True)
    arrived: list[int] = []
    for i, group in enumerate(batches, start=1):
        arrived.extend(group)
        if mode == "full":
            state = full_state(state, events.where(F.col(batch_col).isin(list(arrived))), with_action,
                               touched=F.col(batch_col).isin(list(group)))
        elif mode == "incremental":
            state = advance_state(state, events.where(F.col(batch_col).isin(list(group))), with_action)
        else:
            raise ValueError(f"unknown mode {mode!r}")
        if with_action and i < len(batches):
            state = state.drop("_action")
        if checkpoint_every and i % checkpoint_every == 0 and i < len(batches):
            state = state.checkpoint(eager=True)
    return state


def replay_status(events: DataFrame, batches: Sequence[Sequence[int]], mode: str = "full",
                  batch_col: str = "batch_id") -> DataFrame:
    if mode == "delta_only":
        target = empty_status(events.sparkSession)
        for group in batches:
            target = upsert_status(target, latest_status(events.where(F.col(batch_col).isin(list(group)))))
        return target
    return state_to_status(replay_state(events, batches, mode, batch_col))


_EVENT_FIELDS = ["status_ts", "event_id", "customer_id", "new_status"]


def replay_fold(events: DataFrame, batches: Sequence[Sequence[int]], batch_col: str = "batch_id") -> DataFrame:
    """The same replay in one pass: one scan, one shuffle on ``order_id``.

    Per order, one conditional ``max(struct)`` per batch group gives that group's
    latest event (partial aggregation runs before the exchange, so a hot order
    costs one row per map partition). The merge is then folded over the
    per-order array of group latests with ``aggregate`` -- at most one element
    per batch group -- applying the very guard expressions of ``upsert``. At
    every step the source is the latest event so far, as in a full rescan.
    """
    ev = events.where(F.col("order_id").isNotNull())
    ev_struct = F.struct(*[F.col(c) for c in _EVENT_FIELDS])
    per_group = [F.max(F.when(F.col(batch_col).isin(list(g)), ev_struct)).alias(f"_g{i}")
                 for i, g in enumerate(batches)]
    per = ev.groupBy("order_id").agg(*per_group)
    ev_type = per.schema[f"_g0"].dataType
    init = F.struct(
        F.lit(None).cast("boolean").alias("t"),
        F.lit(None).cast("bigint").alias("customer_id"),
        F.lit(None).cast("string").alias("previous_status"),
        F.lit(None).cast("string").alias("current_status"),
        F.lit(None).cast("timestamp_ntz").alias("last_update_ts"),
        F.lit(None).cast(ev_type).alias("le"))

    def step(acc, g):
        le = (F.when(acc["le"].isNull(), g).when(g.isNull(), acc["le"])
              .otherwise(F.greatest(acc["le"], g)))
        cols = merge_columns(
            acc["t"], F.when(le.isNotNull(), F.lit(True)),
            {c: acc[c] for c in STATUS_COLUMNS if c != "order_id"},
            {"customer_id": le["customer_id"], "new_status": le["new_status"], "ts": le["status_ts"]})
        return F.struct(F.when(le.isNotNull(), F.lit(True)).alias("t"),
                        *[cols[c].alias(c) for c in STATUS_COLUMNS if c != "order_id"],
                        le.alias("le"))

    groups = [F.col(f"_g{i}") for i in range(len(batches))]
    # Orders with no event in any group never get a row. Filter before the fold, not on its
    # result: a filter on the folded column would be inlined and fold every order twice.
    present = per.where(F.coalesce(*groups).isNotNull())
    folded = present.select("order_id", F.aggregate(F.array(*groups), init, step).alias("_st"))
    return folded.select("order_id", *[F.col(f"_st.{c}").alias(c) for c in STATUS_COLUMNS if c != "order_id"])
