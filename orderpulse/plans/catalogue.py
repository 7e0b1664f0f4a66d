"""The query catalogue: one callable (spark, sf_dir) -> DataFrame per operator.

Every query reads whole driver tables (through the fixture views) and its work
grows with them. ``ORACLES`` holds the matching DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.functions.partitioning import customer_partition, hash_partition, placed
from orderpulse.operators import monitor as M
from orderpulse.operators import reconcile as R
from orderpulse.operators import validate as V
from orderpulse.functions.scalars import add_seconds, seconds_between, synthetic_event_id
from orderpulse.operators.enrich import CATEGORY_BASE_PRICE, price_band
from orderpulse.operators.latest import latest_status
from orderpulse.plans import oracle as O
from orderpulse.plans.replay import FIVE_BATCHES, TWO_BATCHES, replay_fold, replay_status
from orderpulse.schemas import STATUS_SCHEMA
from orderpulse.session import list_names, scratch_path
from orderpulse.sinks.maintained import RecentHeads, StatusDistribution
from orderpulse.sinks.snapshot import SnapshotStore
from orderpulse.sources.fixtures import (existing_orders_sample, fx_events, fx_inventory, fx_keys,
                                         fx_order_lines, fx_orders)
from orderpulse.sources.messages import decode_messages, encode_messages
from orderpulse.sinks.raw import read_batch, read_raw, unconsumed
from orderpulse.sinks.summaries import RANK_ERROR, BatchSummaries
from orderpulse.sinks.tables import append_table, ensure_database, ensure_table, load_table
from orderpulse.sinks.topic import publish_files
from orderpulse.sinks.transitions import TransitionMatrix
from orderpulse.sources.tables import read_table
from orderpulse.streaming import land_merge as P
from orderpulse.streaming import progress
from orderpulse.streaming import stalled
from orderpulse.streaming import stateful as S
from orderpulse.streaming.sources import file_messages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


_LATEST_SELECT = ("select order_id, event_id, customer_id, new_status, status_ts as last_event_ts "
                  "from ({latest}) l")


def _latest_oracle(variant: str) -> str:
    return O.with_ctes([f"fx as ({O.fx_events_sql(variant)})"],
                       _LATEST_SELECT.format(latest=O.latest_sql("fx")))


# --- latest event per order (W1) -------------------------------------------------

@register("latest_status", _latest_oracle("base"))
def q_latest_status(spark, sf_dir):
    return latest_status(fx_events(spark, sf_dir))


@register("latest_status_window", _latest_oracle("base"))
def q_latest_status_window(spark, sf_dir):
    return latest_status(fx_events(spark, sf_dir), method="window")


@register("latest_status_max_by", _latest_oracle("base"))
def q_latest_status_max_by(spark, sf_dir):
    return latest_status(fx_events(spark, sf_dir), method="max_by")


@register("latest_status_day_grain", _latest_oracle("day"))
def q_latest_status_day_grain(spark, sf_dir):
    return latest_status(fx_events(spark, sf_dir, "day"))


@register("latest_status_nulls", _latest_oracle("nulls"))
def q_latest_status_nulls(spark, sf_dir):
    return latest_status(fx_events(spark, sf_dir, "nulls"))


# --- conditional upsert (K7) -----------------------------------------------------

@register("merge_initial", O.status_chain_sql("base", [[0, 1, 2, 3, 4]]))
def q_merge_initial(spark, sf_dir):
    return replay_status(fx_events(spark, sf_dir), [[0, 1, 2, 3, 4]])


@register("merge_two_batches", O.status_chain_sql("base", TWO_BATCHES))
def q_merge_two_batches(spark, sf_dir):
    return replay_status(fx_events(spark, sf_dir), TWO_BATCHES, "full")


@register("merge_two_batches_incremental", O.status_chain_sql("base", TWO_BATCHES))
def q_merge_two_batches_incremental(spark, sf_dir):
    return replay_status(fx_events(spark, sf_dir), TWO_BATCHES, "incremental")


@register("merge_five_batches", O.status_chain_sql("base", FIVE_BATCHES))
def q_merge_five_batches(spark, sf_dir):
    return replay_status(fx_events(spark, sf_dir), FIVE_BATCHES, "full")


@register("merge_five_batches_incremental", O.status_chain_sql("base", FIVE_BATCHES))
def q_merge_five_batches_incremental(spark, sf_dir):
    return replay_status(fx_events(spark, sf_dir), FIVE_BATCHES, "incremental")


@register("merge_two_batches_fold", O.status_chain_sql("base", TWO_BATCHES))
def q_merge_two_batches_fold(spark, sf_dir):
    return replay_fold(fx_events(spark, sf_dir), TWO_BATCHES)


@register("merge_five_batches_fold", O.status_chain_sql("base", FIVE_BATCHES))
def q_merge_five_batches_fold(spark, sf_dir):
    return replay_fold(fx_events(spark, sf_dir), FIVE_BATCHES)


@register("merge_nulls_fold", O.status_chain_sql("nulls", FIVE_BATCHES))
def q_merge_nulls_fold(spark, sf_dir):
    return replay_fold(fx_events(spark, sf_dir, "nulls"), FIVE_BATCHES)


@register("merge_day_grain", O.status_chain_sql("day", FIVE_BATCHES))
def q_merge_day_grain(spark, sf_dir):
    return replay_status(fx_events(spark, sf_dir, "day"), FIVE_BATCHES, "incremental")


@register("merge_nulls", O.status_chain_sql("nulls", FIVE_BATCHES))
def q_merge_nulls(spark, sf_dir):
    return replay_status(fx_events(spark, sf_dir, "nulls"), FIVE_BATCHES, "incremental")


@register("merge_delta_only", O.status_chain_sql("base", FIVE_BATCHES, cumulative=False))
def q_merge_delta_only(spark, sf_dir):
    # Deliberately not the reference semantics (see replay.py): each merge sees its own batch only.
    return replay_status(fx_events(spark, sf_dir), FIVE_BATCHES, "delta_only")


# --- validation (V1-V5, V8-V10) ----------------------------------------------------



def fx_status(spark, sf_dir, variant="base", batches=TWO_BATCHES):
    """Current status after merging the arrival batches (one-pass replay)."""
    return replay_fold(fx_events(spark, sf_dir, variant), batches)


def _on_status(select: str, variant: str = "base", batches=TWO_BATCHES) -> str:
    return O.status_chain_sql(variant, batches, select)


@register("validate_counts", _on_status(
    "select (select count(*) from fx) as raw_events, (select count(distinct order_id) from fx) as raw_orders, "
    "(select count(*) from st) as dwh_orders"))
def q_validate_counts(spark, sf_dir):
    return V.validate_counts(fx_events(spark, sf_dir), fx_status(spark, sf_dir))


@register("validate_freshness", _on_status("select max(last_update_ts) as dwh_last_update from st"))
def q_validate_freshness(spark, sf_dir):
    return V.validate_freshness(fx_status(spark, sf_dir))


@register("status_distribution", _on_status(
    "select current_status, count(*) as n from st group by current_status order by n desc, current_status"))
def q_status_distribution(spark, sf_dir):
    return V.status_distribution(fx_status(spark, sf_dir))


@register("orphan_orders", _on_status(
    "select count(*) as missing_in_raw_orders from st d where not exists (select 1 from orders o "
    "where o.o_orderkey = d.order_id and (o.o_orderstatus is null or o.o_orderstatus <> 'F'))"))
def q_orphan_orders(spark, sf_dir):
    return V.orphan_orders(fx_status(spark, sf_dir), fx_order_lines(spark, sf_dir, partial=True))


_MISMATCH = ("select count(*) as mismatches from ({latest}) l join st d on l.order_id = d.order_id "
             "where l.new_status <> d.current_status").format(latest=O.latest_sql("fx"))


@register("latest_mismatch", _on_status(_MISMATCH))
def q_latest_mismatch(spark, sf_dir):
    return V.latest_mismatch(fx_events(spark, sf_dir), fx_status(spark, sf_dir))


@register("latest_mismatch_day_grain", _on_status(_MISMATCH, "day", FIVE_BATCHES))
def q_latest_mismatch_day_grain(spark, sf_dir):
    return V.latest_mismatch(fx_events(spark, sf_dir, "day"), fx_status(spark, sf_dir, "day", FIVE_BATCHES))


@register("orphan_orders_all", _on_status(
    "select count(*) as missing_in_raw_orders from st d where not exists (select 1 from orders o "
    "where o.o_orderkey = d.order_id)"))
def q_orphan_orders_all(spark, sf_dir):
    return V.orphan_orders(fx_status(spark, sf_dir), fx_order_lines(spark, sf_dir))


@register("duplicate_events", O.with_ctes(
    [f"fx as ({O.fx_events_sql('dup')})"],
    "select event_id, count(*) as copies from fx group by event_id having count(*) > 1"))
def q_duplicate_events(spark, sf_dir):
    return V.duplicate_events(fx_events(spark, sf_dir, "dup"))


@register("duplicate_orders", _on_status(
    "select order_id, count(*) as copies from st group by order_id having count(*) > 1"))
def q_duplicate_orders(spark, sf_dir):
    return V.duplicate_orders(fx_status(spark, sf_dir))


def _transitions_sql(variant: str) -> str:
    inner = ("select lag(new_status) over w as from_status, new_status as to_status, "
             "row_number() over w as rn from fx window w as (partition by order_id "
             "order by status_ts asc nulls first, event_id asc nulls first)")
    return O.with_ctes(
        [f"fx as ({O.fx_events_sql(variant)})"],
        f"select from_status, to_status, count(*) as n, "
        f"{O.transition_class_sql('from_status', 'to_status')} as transition "
        f"from ({inner}) p where rn > 1 group by from_status, to_status")


@register("status_transitions", _transitions_sql("base"))
def q_status_transitions(spark, sf_dir):
    return V.status_transitions(fx_events(spark, sf_dir))


@register("status_transitions_nulls", _transitions_sql("nulls"))
def q_status_transitions_nulls(spark, sf_dir):
    return V.status_transitions(fx_events(spark, sf_dir, "nulls"))


# Far past 2^53, where neighbouring whole numbers share one double.
LARGE_ID = 1_800_000_000_000_000_000


@register("status_transitions_large_ids", _transitions_sql("base").replace(
    "user_id as order_id", f"user_id + {LARGE_ID} as order_id"))
def q_status_transitions_large_ids(spark, sf_dir):
    events = fx_events(spark, sf_dir)
    return V.status_transitions(events.withColumn("order_id", F.col("order_id") + F.lit(LARGE_ID)))


AS_OF = "2024-02-01 00:00:00"
MAX_LAG_SECONDS = 2 * 86400


@register("freshness_lag", O.with_ctes(
    [f"fx as ({O.fx_events_sql()})"],
    f"select max(status_ts) as latest_event_ts, timestamp '{AS_OF}' as as_of, "
    f"cast(floor(date_diff('microsecond', max(status_ts), timestamp '{AS_OF}') / 1000000) as bigint) "
    f"as lag_seconds, floor(date_diff('microsecond', max(status_ts), timestamp '{AS_OF}') / 1000000) "
    f"<= {MAX_LAG_SECONDS} as is_fresh from fx"))
def q_freshness_lag(spark, sf_dir):
    return V.freshness_lag(fx_events(spark, sf_dir), F.lit(AS_OF).cast("timestamp_ntz"), MAX_LAG_SECONDS)


# --- monitoring (V6, V7, V12) --------------------------------------------------------

_SLICE = ("select order_id, customer_id, current_status, previous_status, last_update_ts from st "
          "order by last_update_ts desc nulls last, order_id limit 1000")


@register("recent_status_top1000", _on_status(_SLICE))
def q_recent_status(spark, sf_dir):
    return M.recent_status(fx_status(spark, sf_dir))


@register("dashboard_metrics", _on_status(
    f"select (select count(distinct order_id) from ({_SLICE}) a) as tracked_orders, "
    f"coalesce(strftime((select max(last_update_ts) from ({_SLICE}) b), '%Y-%m-%d %H:%M:%S.%f'), 'N/A') "
    f"as latest_update, (select count(*) from fx) as total_events, "
    f"(select count(distinct order_id) from fx) as unique_orders, (select max(status_ts) from fx) as latest_event, "
    f"(select count(distinct order_id) from st) as tracked_orders_full"))
def q_dashboard_metrics(spark, sf_dir):
    return M.dashboard_metrics(fx_status(spark, sf_dir), fx_events(spark, sf_dir))


@register("status_counts_slice", _on_status(
    f"select current_status, count(*) as n from ({_SLICE}) s where current_status is not null "
    f"group by current_status"))
def q_status_counts_slice(spark, sf_dir):
    return M.status_counts_slice(fx_status(spark, sf_dir))


FILTER_STATUSES = ["SHIPPED", "DELIVERED"]
FILTER_SINCE = "2024-01-29 00:00:00"


@register("orders_by_filter", _on_status(
    "select * from st where current_status in ('SHIPPED', 'DELIVERED') "
    f"and last_update_ts >= timestamp '{FILTER_SINCE}'"))
def q_orders_by_filter(spark, sf_dir):
    return M.filter_status(fx_status(spark, sf_dir), statuses=FILTER_STATUSES, since=FILTER_SINCE)


# --- enrichment, scalars, partition columns -------------------------------------------

@register("enrich_price", O.fx_orders_sql())
def q_enrich_price(spark, sf_dir):
    return fx_orders(spark, sf_dir)


@register("price_band", O.with_ctes(
    [f"inv as ({O.fx_inventory_sql()})",
     "base as (select category, cast(cast(((2 * sum(cast(unit_price * 100 as bigint)) + count(unit_price)) "
     "// (2 * count(unit_price))) as decimal(20,0)) / 100 as decimal(10,2)) as base_price "
     "from inv group by category)",
     "b as (select inv.*, base_price, cast(round(base_price * 0.4, 2) as decimal(10,2)) as band_low, "
     "cast(round(base_price * 1.8, 2) as decimal(10,2)) as band_high from inv left join base using (category))"],
    "select product_id, category, unit_price, base_price, band_low, band_high, "
    "case when unit_price is not null then greatest(band_low, least(band_high, unit_price)) end as banded_price, "
    "concat_ws(' ', category, product_name) as product_label from b"))
def q_price_band(spark, sf_dir):
    return price_band(fx_inventory(spark, sf_dir))


_CATEGORY_NAMES = [*sorted(CATEGORY_BASE_PRICE), "Other"]


@register("price_band_fixed", O.with_ctes(
    ["inv as (select p_partkey as product_id, p_name as product_name, cast(p_retailprice as decimal(10,2)) as unit_price, "
     f"({_CATEGORY_NAMES})[p_partkey % {len(_CATEGORY_NAMES)} + 1] as category from part)",
     "base as (select * from (values " + ", ".join(f"('{k}', cast({v} as decimal(10,2)))" for k, v in CATEGORY_BASE_PRICE.items())
     + ") v(category, base_price))",
     "b as (select inv.*, base_price, cast(round(base_price * 0.4, 2) as decimal(10,2)) as band_low, "
     "cast(round(base_price * 1.8, 2) as decimal(10,2)) as band_high from inv left join base using (category))"],
    "select product_id, category, unit_price, base_price, band_low, band_high, "
    "case when unit_price is not null then greatest(band_low, least(band_high, unit_price)) end as banded_price, "
    "concat_ws(' ', category, product_name) as product_label from b"))
def q_price_band_fixed(spark, sf_dir):
    """Bands around the fixed base prices; a product of no listed category has no band."""
    names = F.array(*map(F.lit, _CATEGORY_NAMES))
    category = F.element_at(names, (F.col("product_id") % len(_CATEGORY_NAMES) + 1).cast("int"))
    return price_band(fx_inventory(spark, sf_dir).withColumn("category", category), CATEGORY_BASE_PRICE)


@register("seconds_plus", O.with_ctes(
    [f"fx as ({O.fx_events_sql('nulls')})"],
    "select event_id, status_ts + to_seconds(cast(event_id as bigint) % 86400) as due_ts, "
    "case when status_ts is not null then cast(event_id as bigint) % 86400 end as wait_seconds from fx"))
def q_seconds_plus(spark, sf_dir):
    """Times a number of seconds later, and the whole seconds between."""
    events = fx_events(spark, sf_dir, "nulls")
    due = add_seconds(F.col("status_ts"), F.col("event_id").cast("bigint") % 86400)
    return events.select("event_id", due.alias("due_ts"), seconds_between(F.col("status_ts"), due).alias("wait_seconds"))


@register("existing_orders_sample", "select o_orderkey as order_id, o_custkey as customer_id from orders "
                                    "order by o_orderkey limit 20")
def q_existing_orders_sample(spark, sf_dir):
    return existing_orders_sample(fx_order_lines(spark, sf_dir))


AVAILABLE_PARTITIONS = [0, 1, 2, 4, 5, 7]
_KEYS_SQL = ("select 'customer:' || cast(c_custkey as varchar) as key from customer "
             "union all select 'abc' union all select '' union all select null")


@register("partition_by_hash", O.with_ctes(
    [f"k as ({_KEYS_SQL})"],
    f"select key, {O.hash_partition_sql('key', AVAILABLE_PARTITIONS)} as partition from k"))
def q_partition_by_hash(spark, sf_dir):
    keys = fx_keys(spark, sf_dir)
    return keys.select("key", hash_partition(F.col("key"), AVAILABLE_PARTITIONS).alias("partition"))


@register("partition_by_customer", O.with_ctes(
    [f"k as ({_KEYS_SQL})"],
    f"select key, {O.customer_partition_sql('key', AVAILABLE_PARTITIONS)} as partition from k"))
def q_partition_by_customer(spark, sf_dir):
    keys = fx_keys(spark, sf_dir)
    return keys.select("key", customer_partition(F.col("key"), AVAILABLE_PARTITIONS).alias("partition"))


@register("json_round_trip", O.with_ctes(
    [f"fx as ({O.fx_events_sql('nulls')})"],
    "select event_id, order_id, customer_id, new_status, status_ts, source, "
    "json_object('event_id', event_id, 'order_id', order_id, 'customer_id', customer_id, "
    "'new_status', new_status, 'status_ts', strftime(status_ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00', "
    "'source', source) as value from fx"))
def q_json_round_trip(spark, sf_dir):
    msgs = encode_messages(fx_events(spark, sf_dir, "nulls").drop("batch_id"))
    decoded = decode_messages(msgs.withColumn("value_copy", F.col("value")))
    return decoded.select("event_id", "order_id", "customer_id", "new_status", "status_ts", "source",
                          F.col("value_copy").alias("value"))


CONSUMED_BEFORE = 3


@register("unconsumed_delta", O.with_ctes(
    [f"fx as ({O.fx_events_sql()})",
     f"consumed as (select distinct batch_id from fx where batch_id < {CONSUMED_BEFORE})"],
    "select * from fx where not exists (select 1 from consumed c where c.batch_id = fx.batch_id)"))
def q_unconsumed_delta(spark, sf_dir):
    """Raw rows of the batches after the last one in the run log: one scan, pruned by partition."""
    paths = P.PipelinePaths(scratch_path(spark, "unconsumed"))
    P.land_all(fx_events(spark, sf_dir), paths)
    P.refresh(spark, paths, "incremental", up_to_batch=CONSUMED_BEFORE - 1)
    return unconsumed(read_raw(spark, paths.raw), SnapshotStore(spark, paths.store).latest_commit())


# --- streaming: topic -> raw -> status (S1 S6 K1 T1-T9) ----------------------------------



# Which events are also sent as bad messages (malformed, without the order's key, with a bad
# time), and those messages as SQL text.
BAD_EVERY = {"malformed": 53, "missing order_id": 59, "bad status_ts": 61}
BAD_TEXT = {
    "malformed": """concat('{"event_id":"', event_id, '", oops')""",
    "missing order_id": """concat('{"event_id":"', event_id, '","customer_id":1,"new_status":"PAID",'
                       '"status_ts":"2024-01-01T00:00:00+00:00"}')""".replace("'\n                       '", ""),
    "bad status_ts": """concat('{"event_id":"', event_id, '","order_id":1,"customer_id":1,"new_status":"PAID","status_ts":"soon"}')""",
}
_BAD_SQL = " union all ".join(
    f"select '{reason}' as reason, {BAD_TEXT[reason]} as value, batch_id from fx where cast(event_id as bigint) % {n} = 0"
    for reason, n in BAD_EVERY.items())


def bad_messages(events: DataFrame) -> DataFrame:
    parts = [events.where(F.col("event_id").cast("bigint") % n == 0)
             .select(F.expr(BAD_TEXT[reason]).alias("value"), "batch_id") for reason, n in BAD_EVERY.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def run_stream_waves(spark, sf_dir, batches, shape: str = "land_merge", mode: str = "incremental",
                     variant: str = "base", with_bad: bool = False, dedupe: bool | str = False,
                     root: str | None = None, events: DataFrame | None = None, bad_alone: bool = False) -> SnapshotStore:
    """Publish each batch group in turn (JSON-line files, the topic stand-in) and drain the
    pipeline after each, restarting from its checkpoint every time. Bad messages come with the wave
    that they are made from, or (``bad_alone``) as a wave of their own after it."""
    root = root or scratch_path(spark, f"stream_{shape}")
    paths = P.PipelinePaths(root)
    landing = f"{root}/landing"
    events = fx_events(spark, sf_dir, variant) if events is None else events
    for group, bad_wave in [(g, w) for g in batches for w in ((False, True) if bad_alone else (False,))]:
        wave = events.where(F.col("batch_id").isin(list(group)))
        if not bad_wave:
            publish_files(wave, landing)
        if with_bad or bad_wave:
            bad_messages(wave).select("value").write.mode("append").text(landing)
        messages = file_messages(spark, landing)
        if shape == "land_merge":
            P.run_to_completion(P.start_land_merge(messages, paths, mode, trigger="drain", dedupe=dedupe))
            continue
        P.run_to_completion(P.start_raw_landing(messages, paths, trigger="drain", dedupe=dedupe))
        merge = P.start_refresh if shape == "raw_refresh" else S.start_stateful_merge
        P.run_to_completion(merge(spark, paths, trigger="drain"))
    return SnapshotStore(spark, paths.store)


@register("stream_land_merge", O.status_chain_sql("base", TWO_BATCHES))
def q_stream_land_merge(spark, sf_dir):
    return run_stream_waves(spark, sf_dir, TWO_BATCHES).read_status()


@register("stream_land_merge_full", O.status_chain_sql("base", FIVE_BATCHES))
def q_stream_land_merge_full(spark, sf_dir):
    return run_stream_waves(spark, sf_dir, FIVE_BATCHES, mode="full").read_status()


@register("stream_raw_refresh", O.status_chain_sql("base", TWO_BATCHES))
def q_stream_raw_refresh(spark, sf_dir):
    return run_stream_waves(spark, sf_dir, TWO_BATCHES, shape="raw_refresh").read_status()


_RUN_LOG_COLUMNS = ["batch_id", "rows_in", "rows_bad", "inserted", "updated", "unchanged", "max_status_ts"]


@register("run_log", O.run_log_sql("base", FIVE_BATCHES))
def q_run_log(spark, sf_dir):
    return run_stream_waves(spark, sf_dir, FIVE_BATCHES).run_log().select(*_RUN_LOG_COLUMNS)


def _run_log_bad_sql() -> str:
    bad = " union all ".join(
        f"select cast({i} as bigint) as batch_id, count(*) as n from bad where batch_id in ({', '.join(map(str, g))})"
        for i, g in enumerate(FIVE_BATCHES))
    return O.with_ctes(
        [f"rl as ({O.run_log_sql('base', FIVE_BATCHES)})", f"fx as ({O.fx_events_sql()})", f"bad as ({_BAD_SQL})", f"c as ({bad})"],
        "select rl.batch_id, rows_in, c.n as rows_bad, inserted, updated, unchanged, max_status_ts "
        "from rl join c on rl.batch_id = c.batch_id")


@register("run_log_bad", _run_log_bad_sql())
def q_run_log_bad(spark, sf_dir):
    return run_stream_waves(spark, sf_dir, FIVE_BATCHES, with_bad=True).run_log().select(*_RUN_LOG_COLUMNS)


@register("run_log_refresh_bad", _run_log_bad_sql())
def q_run_log_refresh_bad(spark, sf_dir):
    store = run_stream_waves(spark, sf_dir, FIVE_BATCHES, shape="raw_refresh", with_bad=True)
    return store.run_log().select(*_RUN_LOG_COLUMNS)


@register("run_log_bad_alone", O.with_ctes(
    [f"rl as ({O.run_log_sql('base', TWO_BATCHES)})", f"fx as ({O.fx_events_sql()})", f"bad as ({_BAD_SQL})"],
    "select batch_id * 2 as batch_id, rows_in, rows_bad, inserted, updated, unchanged, max_status_ts from rl " + "".join(
        f"union all select {2 * i + 1}, 0, (select count(*) from bad where batch_id in ({', '.join(map(str, g))})), 0, 0, 0, null "
        for i, g in enumerate(TWO_BATCHES))))
def q_run_log_bad_alone(spark, sf_dir):
    """Landing and merging as two queries, with waves of bad messages alone: each is a commit that counts them."""
    store = run_stream_waves(spark, sf_dir, TWO_BATCHES, shape="raw_refresh", bad_alone=True)
    return store.run_log().select(*_RUN_LOG_COLUMNS)


@register("stream_quarantine", O.with_ctes([f"fx as ({O.fx_events_sql()})"], f"select reason, value from ({_BAD_SQL}) b"))
def q_stream_quarantine(spark, sf_dir):
    root = scratch_path(spark, "stream_quarantine")
    run_stream_waves(spark, sf_dir, TWO_BATCHES, shape="raw_refresh", with_bad=True, root=root)
    return P.quarantined(spark, P.PipelinePaths(root)).select("reason", "value")


@register("stream_dedupe", O.with_ctes(
    [f"fx as ({O.fx_events_sql()})"], "select event_id, order_id, customer_id, new_status, status_ts, source from fx"))
def q_stream_dedupe(spark, sf_dir):
    """Every wave is sent twice; the raw table holds each event once."""
    root = scratch_path(spark, "stream_dedupe")
    run_stream_waves(spark, sf_dir, [*TWO_BATCHES, *TWO_BATCHES], shape="raw_refresh", dedupe=True, root=root)
    return read_raw(spark, P.PipelinePaths(root).raw).drop("batch_id")


@register("counts_over_time", O.with_ctes(
    [f"rl as ({O.run_log_sql('base', FIVE_BATCHES)})",
     "c as (select batch_id, rows_in, inserted, cast(sum(rows_in) over w as bigint) as total_events, "
     "cast(sum(inserted) over w as bigint) as total_orders from rl "
     "window w as (order by batch_id rows between unbounded preceding and current row))"],
    "select batch_id, rows_in, inserted, total_events, total_orders, "
    "coalesce(total_orders >= lag(total_orders) over (order by batch_id), true) as orders_grew from c"))
def q_counts_over_time(spark, sf_dir):
    return V.counts_over_time(run_stream_waves(spark, sf_dir, FIVE_BATCHES).run_log())


def run_refresh(spark, sf_dir, batches, mode: str = "incremental") -> SnapshotStore:
    """Land every batch into the raw table at once, then run the scheduled merge after
    each batch group's arrival (``up_to_batch``)."""
    paths = P.PipelinePaths(scratch_path(spark, f"refresh_{mode}"))
    P.land_all(fx_events(spark, sf_dir), paths)
    for group in batches:
        P.refresh(spark, paths, mode, up_to_batch=max(group))
    P.refresh(spark, paths, mode, up_to_batch=max(max(g) for g in batches))  # nothing new: no-op
    return SnapshotStore(spark, paths.store)


@register("refresh_incremental", O.status_chain_sql("base", TWO_BATCHES))
def q_refresh_incremental(spark, sf_dir):
    return run_refresh(spark, sf_dir, TWO_BATCHES).read_status()


@register("refresh_full", O.status_chain_sql("base", FIVE_BATCHES))
def q_refresh_full(spark, sf_dir):
    return run_refresh(spark, sf_dir, FIVE_BATCHES, "full").read_status()


@register("unconsumed_after_refresh", O.with_ctes(
    [f"fx as ({O.fx_events_sql()})"],
    "select event_id, order_id, customer_id, new_status, status_ts, source, batch_id from fx where batch_id > 1"))
def q_unconsumed_after_refresh(spark, sf_dir):
    """Raw rows not yet merged: raw partitions after the last batch in the run log."""
    paths = P.PipelinePaths(scratch_path(spark, "refresh_peek"))
    P.land_all(fx_events(spark, sf_dir), paths)
    P.refresh(spark, paths, "incremental", up_to_batch=0)
    P.refresh(spark, paths, "incremental", up_to_batch=1)
    last = SnapshotStore(spark, paths.store).run_log().agg(F.max("batch_id")).scalar()
    return read_raw(spark, paths.raw).where(F.col("batch_id") > F.coalesce(last, F.lit(-1)))


@register("stream_stateful_merge", O.status_chain_sql("base", TWO_BATCHES))
def q_stream_stateful_merge(spark, sf_dir):
    """The same two arrival waves through the keyed-state variant."""
    return run_stream_waves(spark, sf_dir, TWO_BATCHES, shape="stateful").read_status()


@register("stream_stateful_hot_large", O.status_chain_sql("base", TWO_BATCHES).replace(
    "user_id as order_id", f"case when event_id % 3 = 0 then {LARGE_ID} else user_id + {LARGE_ID} end as order_id"))
def q_stream_stateful_hot_large(spark, sf_dir):
    """Keyed state with one order that a third of all events have, and ids past 2^53."""
    hot = F.when(F.col("event_id").cast("bigint") % 3 == 0, F.lit(LARGE_ID)).otherwise(F.col("order_id") + F.lit(LARGE_ID))
    events = fx_events(spark, sf_dir).withColumn("order_id", hot)
    return run_stream_waves(spark, sf_dir, TWO_BATCHES, shape="stateful", events=events).read_status()


@register("table_lifecycle", "select c_custkey as order_id, c_nationkey as customer_id, cast(null as varchar) as previous_status, "
                             "c_mktsegment as current_status, timestamp '2024-01-01' as last_update_ts from customer "
                             "union all select c_custkey + 1000000000, c_nationkey, c_mktsegment, c_mktsegment, "
                             "timestamp '2024-01-02' from customer")
def q_table_lifecycle(spark, sf_dir):
    """Create database and typed table, overwrite-load, append, empty append (no rows), replace and load
    again, read back."""
    ensure_database(spark, "orderpulse")
    path = f"{scratch_path(spark, 'lifecycle')}/status"
    customers = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    first = customers.select(F.col("c_custkey").alias("order_id"), F.col("c_nationkey").cast("bigint").alias("customer_id"),
                             F.lit(None).cast("string").alias("previous_status"), F.col("c_mktsegment").alias("current_status"),
                             F.lit("2024-01-01").cast("timestamp_ntz").alias("last_update_ts"))
    second = first.withColumns({"order_id": F.col("order_id") + 1_000_000_000, "previous_status": F.col("current_status"),
                                "last_update_ts": F.lit("2024-01-02").cast("timestamp_ntz")})
    ensure_table(spark, path, STATUS_SCHEMA)
    load_table(second, path, STATUS_SCHEMA)
    ensure_table(spark, path, STATUS_SCHEMA, replace=True)
    load_table(first, path, STATUS_SCHEMA)
    append_table(second, path, STATUS_SCHEMA)
    append_table(second.limit(0), path, STATUS_SCHEMA)
    return ensure_table(spark, path, STATUS_SCHEMA)


# --- maintained metrics: no rescan of events or status (A3 A4 A6 O1 T5 V1 V3 V5 V7 V9 V10) --------------------


def landed_batches(spark, events: DataFrame, name: str) -> list[tuple[int, DataFrame]]:
    """The events landed as raw batches, and each batch read from its own folder, in order."""
    paths = P.PipelinePaths(scratch_path(spark, name))
    P.land_all(events, paths)
    ids = sorted(int(n.split("=")[1]) for n in list_names(spark, paths.raw) if n.startswith("batch_id="))
    return [(b, read_batch(spark, paths.raw, b)) for b in ids]


def summarised(spark, events: DataFrame) -> BatchSummaries:
    """Every batch summarised as it lands, the first two folded, and the third landed once more."""
    out = BatchSummaries(spark, scratch_path(spark, "summaries"))
    batches = landed_batches(spark, events, "summarised")
    for batch_id, rows in batches:
        out.add(rows, batch_id)
        if batch_id == 1:
            out.fold(1)
    out.add(*reversed(batches[2]))
    return out


_EVENT_STATS = ("select count(*) as total_events, count(distinct order_id) as unique_orders, "
                "max(status_ts) as latest_event from fx")


@register("event_stats_maintained", O.with_ctes([f"fx as ({O.fx_events_sql('nulls')})"], _EVENT_STATS))
def q_event_stats_maintained(spark, sf_dir):
    """Counts, exact distinct orders and the newest time from one summary per batch, one landed twice."""
    return summarised(spark, fx_events(spark, sf_dir, "nulls")).event_stats()


@register("event_stats_maintained_any_id", O.with_ctes([f"fx as ({O.fx_events_sql()})"], _EVENT_STATS).replace(
    "user_id as order_id", f"case when event_id % 3 = 0 then -user_id when event_id % 3 = 1 then user_id + {LARGE_ID} "
    "when event_id % 7 > 0 then user_id end as order_id"))
def q_event_stats_maintained_any_id(spark, sf_dir):
    """Negative ids, ids past 2^53 and nulls."""
    n, order = F.col("event_id").cast("bigint"), F.col("order_id")
    ids = F.when(n % 3 == 0, -order).when(n % 3 == 1, order + F.lit(LARGE_ID)).when(n % 7 > 0, order)
    return summarised(spark, fx_events(spark, sf_dir).withColumn("order_id", ids)).event_stats()


LATENESS_RANKS = [0.05, 0.25, 0.5, 0.75, 0.95, 0.99]


@register("lateness_quantiles", O.with_ctes(
    [f"fx as ({O.fx_events_sql('nulls')})",
     "newest as (select b.batch_id, (select max(status_ts) from fx where fx.batch_id < b.batch_id) as seen "
     "from (select distinct batch_id from fx) b)",
     "n as (select count(status_ts) as n_values from fx join newest using (batch_id) where seen is not null)"],
    f"select cast(rank as double) as rank, n_values, true as within_bound from n, unnest({LATENESS_RANKS}) r(rank)"))
def q_lateness_quantiles(spark, sf_dir):
    """Quantiles of lateness from merged sketches, each held against its exact rank among all values."""
    events = fx_events(spark, sf_dir, "nulls")
    out = BatchSummaries(spark, scratch_path(spark, "lateness"))
    batches = landed_batches(spark, events, "landed_late")
    for batch_id, rows in batches:
        out.add(rows, batch_id)
    seen = events.groupBy("batch_id").agg(F.max("status_ts").alias("mx"))
    newest = (events.select("batch_id").distinct().alias("b").join(seen.alias("s"), F.col("s.batch_id") < F.col("b.batch_id"))
              .groupBy("b.batch_id").agg(F.max("s.mx").alias("seen")))  # one row a batch
    late = events.join(newest, "batch_id").select(F.timestamp_diff("SECOND", F.col("status_ts"), F.col("seen")).alias("late")).where("late is not null")
    quantiles = {r["rank"]: r["lateness_seconds"] for r in out.lateness_quantiles(LATENESS_RANKS).collect()}
    # a value's ranks run from the share below it to the share up to it
    counts = late.agg(F.count(F.lit(1)).alias("n_values"), *(
        c for i, q in enumerate(quantiles.values()) for c in (F.count(F.when(F.col("late") < q, 1)).alias(f"below{i}"),
                                                              F.count(F.when(F.col("late") <= q, 1)).alias(f"upto{i}"))))
    rows = [F.struct(F.lit(rank).alias("rank"), "n_values", ((F.col(f"below{i}") <= (rank + RANK_ERROR) * F.col("n_values"))
                     & (F.col(f"upto{i}") >= (rank - RANK_ERROR) * F.col("n_values"))).alias("within_bound")) for i, rank in enumerate(quantiles)]
    return counts.select(F.inline(F.array(*rows)))


def merged_with_views(spark, sf_dir, batches, variant: str = "base", mode: str = "incremental"):
    """The scheduled merge after each batch group, its views advanced after each commit but the second, whose
    changes they catch up with later."""
    paths = P.PipelinePaths(scratch_path(spark, "views"))
    P.land_all(fx_events(spark, sf_dir, variant), paths)
    store = SnapshotStore(spark, paths.store)
    counts, heads = StatusDistribution(store), RecentHeads(store)
    for i, group in enumerate(batches):
        P.refresh(spark, paths, mode, up_to_batch=max(group))
        if i != 1:
            counts.advance()
            heads.advance()
    return counts, heads


@register("status_distribution_maintained", _on_status(
    "select current_status, count(*) as n from st group by current_status", batches=FIVE_BATCHES))
def q_status_distribution_maintained(spark, sf_dir):
    counts, _ = merged_with_views(spark, sf_dir, FIVE_BATCHES)
    return counts.by_status()


_BY_DAY = "select current_status, cast(last_update_ts as date) as day, count(*) as n from st group by 1, 2"


@register("status_by_day_maintained", _on_status(_BY_DAY, "nulls", FIVE_BATCHES))
def q_status_by_day_maintained(spark, sf_dir):
    counts, _ = merged_with_views(spark, sf_dir, FIVE_BATCHES, "nulls")
    return counts.read()


@register("status_by_day_maintained_full", _on_status(_BY_DAY, "day", FIVE_BATCHES))
def q_status_by_day_maintained_full(spark, sf_dir):
    """The same from merges that rescan, at day grain."""
    counts, _ = merged_with_views(spark, sf_dir, FIVE_BATCHES, "day", "full")
    return counts.read()


@register("recent_status_maintained", _on_status(_SLICE, "nulls", FIVE_BATCHES))
def q_recent_status_maintained(spark, sf_dir):
    """The newest 1000 orders from the heads of the state's buckets."""
    _, heads = merged_with_views(spark, sf_dir, FIVE_BATCHES, "nulls")
    return heads.read()


def spliced(spark, events: DataFrame) -> TransitionMatrix:
    """Every batch spliced in as it lands, and the last one landed once more."""
    out = TransitionMatrix(spark, scratch_path(spark, "transitions"))
    batches = landed_batches(spark, events, "spliced")
    for batch_id, rows in [*batches, batches[-1]]:
        out.add(rows, batch_id)
    return out


@register("status_transitions_maintained", _transitions_sql("base"))
def q_status_transitions_maintained(spark, sf_dir):
    """The transition matrix after five batches whose events fall between each other's."""
    return spliced(spark, fx_events(spark, sf_dir)).read()


@register("status_transitions_maintained_hot", _transitions_sql("nulls").replace(
    "user_id as order_id", f"case when event_id % 3 = 0 then {LARGE_ID} else user_id + {LARGE_ID} end as order_id"))
def q_status_transitions_maintained_hot(spark, sf_dir):
    """With an order that a third of all events have, null times and null statuses."""
    hot = F.when(F.col("event_id").cast("bigint") % 3 == 0, F.lit(LARGE_ID)).otherwise(F.col("order_id") + F.lit(LARGE_ID))
    return spliced(spark, fx_events(spark, sf_dir, "nulls").withColumn("order_id", hot)).read()


_DIFFERENCES = ("select coalesce(a.order_id, b.order_id) as order_id, case when b.order_id is null then 'missing' "
                "when a.order_id is null then 'extra' else 'changed' end as kind, a.current_status as left_status, "
                "b.current_status as right_status, a.last_update_ts as left_ts, b.last_update_ts as right_ts "
                "from {a} a full outer join {b} b on a.order_id = b.order_id where a.order_id is null or b.order_id is null "
                "or (a.customer_id, a.previous_status, a.current_status, a.last_update_ts) is distinct from "
                "(b.customer_id, b.previous_status, b.current_status, b.last_update_ts)")


def _told(found: DataFrame) -> DataFrame:
    return found.select("order_id", "kind", F.col("left.current_status").alias("left_status"), F.col("right.current_status").alias("right_status"),
                        F.col("left.last_update_ts").alias("left_ts"), F.col("right.last_update_ts").alias("right_ts"))


@register("reconcile_status", O.status_chain_sql("nulls", TWO_BATCHES, "select * from (" + O.with_ctes(
    ["copy as (select order_id, customer_id, case when order_id % 89 = 0 then current_status else previous_status end as previous_status, "
     "case when order_id % 101 = 0 then null else current_status end as current_status, last_update_ts from st "
     "where order_id % 97 <> 0 union all select -order_id, customer_id, previous_status, current_status, null from st where order_id % 103 = 0)"],
    _DIFFERENCES.format(a="st", b="copy")) + ") d"))
def q_reconcile_status(spark, sf_dir):
    """The status table against a copy that lacks rows, has others and differs in some, nulls among them."""
    status = fx_status(spark, sf_dir, "nulls")
    key, now = F.col("order_id"), F.col("current_status")
    copy = status.where(key % 97 != 0).withColumns({"previous_status": F.when(key % 89 == 0, now).otherwise(F.col("previous_status")),
                                                    "current_status": F.when(key % 101 != 0, now)})
    more = status.where(key % 103 == 0).withColumns({"order_id": -key, "last_update_ts": F.lit(None).cast("timestamp_ntz")})
    return _told(R.reconcile(status, copy.unionByName(more)))


@register("reconcile_stores", O.with_ctes(
    [f"one as ({O.status_chain_sql('base', TWO_BATCHES)})", f"two as ({O.status_chain_sql('base', [[0], [1, 2, 3]])})"],
    _DIFFERENCES.format(a="one", b="two")))
def q_reconcile_stores(spark, sf_dir):
    """Two stores of the same pipeline, one of them a batch behind."""
    paths = [P.PipelinePaths(scratch_path(spark, f"reconcile_{n}")) for n in ("one", "two")]
    for p, last in zip(paths, (4, 3)):
        P.land_all(fx_events(spark, sf_dir), p)
        P.refresh(spark, p, "incremental", up_to_batch=0)
        P.refresh(spark, p, "incremental", up_to_batch=last)
    return _told(R.reconcile_stores(*[SnapshotStore(spark, p.store) for p in paths]))


@register("stream_dedupe_history", O.with_ctes(
    [f"fx as ({O.fx_events_sql()})"], "select event_id, order_id, customer_id, new_status, status_ts, source from fx"))
def q_stream_dedupe_history(spark, sf_dir):
    """The first wave comes again after another one, without any state: its ids are found in the history."""
    root = scratch_path(spark, "stream_dedupe_history")
    run_stream_waves(spark, sf_dir, [*TWO_BATCHES, TWO_BATCHES[0]], shape="raw_refresh", dedupe="history", root=root)
    return read_raw(spark, P.PipelinePaths(root).raw).drop("batch_id")


@register("partition_placement", O.with_ctes(
    [f"k as ({_KEYS_SQL})"],
    f"select key, {O.customer_partition_sql('key', AVAILABLE_PARTITIONS)} as partition, true as there from k"))
def q_partition_placement(spark, sf_dir):
    """Every key lies in the Spark partition that the partitioner assigns to it."""
    assigned = fx_keys(spark, sf_dir).select("key", customer_partition(F.col("key"), AVAILABLE_PARTITIONS).alias("partition"))
    return placed(assigned, "partition", AVAILABLE_PARTITIONS).withColumn("there", F.spark_partition_id() == F.col("partition"))


@register("stream_state_rows", O.with_ctes(
    [f"fx as ({O.fx_events_sql()})"],
    "select 0::bigint as operator_id, 'stateStoreSave' as operator_name, 1::bigint as max_batch, "
    "(select count(distinct order_id) from fx) as state_rows"))
def q_stream_state_rows(spark, sf_dir):
    """The keyed state of the stateful merge, read back from its checkpoint: one row an order."""
    root = scratch_path(spark, "stream_state_rows")
    run_stream_waves(spark, sf_dir, TWO_BATCHES, shape="stateful", root=root)
    return progress.state_summary(spark, f"{root}/_checkpoint/stateful").select("operator_id", "operator_name", "max_batch", "state_rows")


#: Events of an order at most a day apart are one span; it has stalled when a day has gone by after its last event.
def _stalls_sql(as_of: str, variant: str) -> str:
    return O.with_ctes(
        [f"fx as ({O.fx_events_sql(variant)})", "known as (select * from fx where order_id is not null and status_ts is not null)",
         "marked as (select *, case when status_ts - lag(status_ts) over w <= interval 24 hour then 0 else 1 end as fresh "
         "from known window w as (partition by order_id order by status_ts, event_id))",
         "numbered as (select *, sum(fresh) over (partition by order_id order by status_ts, event_id) as span from marked)",
         "ends as (select *, min(status_ts) over (partition by order_id, span) as active_from, row_number() over "
         "(partition by order_id, span order by status_ts desc, event_id desc) as rn from numbered)",
         f"past as (select {as_of} as as_of from known)"],
        "select order_id, active_from, status_ts, event_id, customer_id, new_status, status_ts + interval 24 hour as stalled_at "
        "from ends, past where rn = 1 and status_ts + interval 24 hour <= as_of")


_WATERMARK = "date_trunc('milliseconds', max(status_ts)) - interval 1 hour"


def stalls_in_waves(spark, events: DataFrame) -> DataFrame:
    """Waves of twenty days, where every second event comes half an hour late, landed and searched for stalls in turn."""
    root = scratch_path(spark, "stalls")
    paths = P.PipelinePaths(root)
    arrives = F.unix_timestamp(F.col("status_ts").cast("timestamp")) + F.col("event_id").cast("bigint") % 2 * 1800
    events = events.withColumn("wave", F.coalesce(F.floor(arrives / (20 * 86400)), F.lit(0)))
    for (wave,) in sorted(events.select("wave").distinct().collect()):
        publish_files(events.where(F.col("wave") == wave).drop("wave"), f"{root}/landing")
        P.run_to_completion(P.start_raw_landing(file_messages(spark, f"{root}/landing"), paths, trigger="drain"))
        P.run_to_completion(stalled.start_stalls(spark, paths, trigger="drain"))
    return stalled.read_stalls(spark, paths).drop("batch_id")


@register("stalled_orders", _stalls_sql("max(status_ts)", "nulls"))
def q_stalled_orders(spark, sf_dir):
    """Stalls of all events so far, as of the newest of them."""
    events = fx_events(spark, sf_dir, "nulls")
    newest = events.agg(F.max("status_ts").alias("m"))
    return stalled.stalls(events, newest.select("m").scalar())


@register("stream_stalls", _stalls_sql(_WATERMARK, "base"))
def q_stream_stalls(spark, sf_dir):
    """The spans that the state store has let go when the stream has seen all events."""
    return stalls_in_waves(spark, fx_events(spark, sf_dir))


@register("stream_stalls_hot_large", _stalls_sql(_WATERMARK, "base").replace(
    "user_id as order_id", f"case when event_id % 3 = 0 then {LARGE_ID} else user_id + {LARGE_ID} end as order_id"))
def q_stream_stalls_hot_large(spark, sf_dir):
    """The same with one order that a third of all events have, and ids past 2^53."""
    hot = F.when(F.col("event_id").cast("bigint") % 3 == 0, F.lit(LARGE_ID)).otherwise(F.col("order_id") + F.lit(LARGE_ID))
    return stalls_in_waves(spark, fx_events(spark, sf_dir).withColumn("order_id", hot))


_PART = "coalesce(length({0}) || ':' || {0}, '-')"
_PARTS = " || ".join(_PART.format(f"cast({c} as varchar)") for c in ("order_id", "customer_id", "new_status", "source"))


@register("event_ids", O.with_ctes([f"fx as ({O.fx_events_sql('nulls')})"],
                                   f"select event_id, sha256({_PARTS}) as synthetic_id from fx"))
def q_event_ids(spark, sf_dir):
    """Ids for messages that carry none, from their other fields."""
    return fx_events(spark, sf_dir, "nulls").select(
        "event_id", synthetic_event_id(*map(F.col, ("order_id", "customer_id", "new_status", "source"))).alias("synthetic_id"))


@register("freshness_now", O.with_ctes(
    [f"fx as ({O.fx_events_sql()})"],
    "select max(status_ts) as latest_event_ts, true as is_now, date_diff('day', max(status_ts), current_timestamp::timestamp) < 2 as is_fresh from fx"))
def q_freshness_now(spark, sf_dir):
    """Freshness against the current time, which is between the times before and after the query."""
    import datetime as dt

    utc = lambda: F.lit(dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    from_, found = utc(), V.freshness_lag(fx_events(spark, sf_dir), None, MAX_LAG_SECONDS)
    minute = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(10))
    lag = F.timestamp_diff("SECOND", F.col("latest_event_ts"), F.col("as_of"))
    return found.select("latest_event_ts", (F.col("as_of").between(from_ - minute, from_ + minute) & (F.abs(lag - F.col("lag_seconds")) <= 1)).alias("is_now"),
                        "is_fresh")


@register("stream_list", O.with_ctes(
    [f"fx as ({O.fx_events_sql()})"],
    "select 'orders-landing' as name, true as running, count(*) as landed from fx"))
def q_stream_list(spark, sf_dir):
    """The list of running streams while one lands all events, beside what its landing log says it landed."""
    root = scratch_path(spark, "stream_list")
    paths = P.PipelinePaths(root)
    publish_files(fx_events(spark, sf_dir), f"{root}/landing")
    query = P.start_raw_landing(file_messages(spark, f"{root}/landing"), paths, trigger="flush", name="orders-landing")
    try:
        query.processAllAvailable()
        listed = P.query_status(spark).where(F.col("id") == str(query.id))
    finally:
        query.stop()
    landed = sum(n.good for n in paths.log(spark).after(-1))
    return listed.select("name", F.col("message").isNotNull().alias("running"), F.lit(landed).cast("bigint").alias("landed"))
