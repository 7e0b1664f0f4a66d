"""DuckDB SQL oracles for the query catalogue.

Each oracle is one SELECT over the pre-registered base tables; fixture views and
multi-batch merges are spelled out as CTE chains.
"""

from __future__ import annotations

from collections.abc import Sequence

from orderpulse.sources.fixtures import EVENT_TYPE_STATUS, N_BATCHES, BATCH_MULTIPLIER

_PRODUCT_RANGE = "(select greatest(1, count(*) * 11 // 10) from part)"
_STATUS_CASE = "case event_type " + " ".join(
    f"when '{k}' then '{v}'" for k, v in EVENT_TYPE_STATUS.items()) + " end"


def fx_events_sql(variant: str = "base") -> str:
    ts, status = "ts", _STATUS_CASE
    if variant == "day":
        ts = "cast(cast(ts as date) as timestamp)"
    elif variant == "nulls":
        ts = "case when event_id % 97 <> 0 then ts end"
        status = f"case when event_id % 89 <> 0 then {_STATUS_CASE} end"
    base = (f"select lpad(cast(event_id as varchar), 12, '0') as event_id, user_id as order_id, "
            f"cast(json_extract_string(props, '$.k') as bigint) as customer_id, {status} as new_status, "
            f"{ts} as status_ts, 'events' as source, "
            f"cast((event_id * {BATCH_MULTIPLIER}) % {N_BATCHES} as bigint) as batch_id from events")
    if variant == "dup":
        base = f"{base} union all {base} where event_id % 50 = 0"
    return base


def fx_inventory_sql() -> str:
    return ("select p_partkey as product_id, p_name as product_name, p_type as category, "
            "cast(p_retailprice as decimal(10,2)) as unit_price from part")


def fx_orders_sql(partial: bool = False) -> str:
    where = " where o_orderstatus is null or o_orderstatus <> 'F'" if partial else ""
    price = "coalesce(cast(p_retailprice as decimal(10,2)), cast(o_totalprice as decimal(10,2)))"
    return (f"select o_orderkey as order_id, o_custkey as customer_id, "
            f"o_orderkey % {_PRODUCT_RANGE} as product_id, 1 + o_orderkey % 5 as quantity, "
            f"{price} as unit_price, cast((1 + o_orderkey % 5) * {price} as decimal(12,2)) as order_total, "
            f"o_orderdate as sold_at from orders left join part on p_partkey = o_orderkey % {_PRODUCT_RANGE}"
            f"{where}")


def latest_sql(source: str, where: str = "true") -> str:
    return ("select order_id, event_id, customer_id, new_status, status_ts from ("
            "select *, row_number() over (partition by order_id "
            "order by status_ts desc nulls last, event_id desc nulls last) as rn "
            f"from {source} where order_id is not null and ({where})) x where rn = 1")


def _joined_sql(prev: str, src: str) -> str:
    return (
        "select t.order_id as t_id, s.order_id as s_id, t.customer_id as t_cust, s.customer_id as s_cust, "
        "t.previous_status, t.current_status, s.new_status, t.last_update_ts, s.status_ts, "
        "t.order_id is not null and s.order_id is not null "
        "and (s.status_ts > t.last_update_ts or t.last_update_ts is null) "
        "and (t.current_status <> s.new_status or t.current_status is null) as upd "
        f"from {prev} t full outer join {src} s on t.order_id = s.order_id")


def _merge_step_sql(joined: str) -> str:
    return (
        "select coalesce(t_id, s_id) as order_id, "
        "case when t_id is null or upd then s_cust else t_cust end as customer_id, "
        "case when t_id is null then null when upd then current_status else previous_status end "
        "as previous_status, "
        "case when t_id is null or upd then new_status else current_status end as current_status, "
        "case when t_id is null or upd then status_ts else last_update_ts end as last_update_ts "
        f"from {joined}")


def merge_chain_ctes(batches: Sequence[Sequence[int]], fx: str = "fx",
                     cumulative: bool = True) -> tuple[list[str], str]:
    """CTEs s_i (merge source), j_i (joined with guard), t_i (status after merge i).

    ``cumulative``: merge i reads every batch arrived so far (the reference's rescan);
    otherwise only batch group i (the delta-only variant)."""
    ctes = ["t0 as (select cast(null as bigint) as order_id, cast(null as bigint) as customer_id, "
            "cast(null as varchar) as previous_status, cast(null as varchar) as current_status, "
            "cast(null as timestamp) as last_update_ts where false)"]
    arrived: list[int] = []
    for i, group in enumerate(batches, start=1):
        arrived.extend(group)
        ids = ", ".join(str(b) for b in (arrived if cumulative else group))
        ctes.append(f"s{i} as ({latest_sql(fx, f'batch_id in ({ids})')})")
        ctes.append(f"j{i} as ({_joined_sql(f't{i - 1}', f's{i}')})")
        ctes.append(f"t{i} as ({_merge_step_sql(f'j{i}')})")
    return ctes, f"t{len(batches)}"


def run_log_sql(variant: str, batches: Sequence[Sequence[int]]) -> str:
    """Per merge: rows_in, rows_bad, inserted, updated, unchanged (matched, in this batch,
    guards held), max_status_ts. Merge i is numbered i-1 (micro-batch ids start at 0)."""
    ctes, _ = merge_chain_ctes(batches)
    ctes = [f"fx as ({fx_events_sql(variant)})"] + ctes
    parts = []
    for i, group in enumerate(batches, start=1):
        ids = ", ".join(str(b) for b in group)
        in_batch = f"(select * from fx where batch_id in ({ids}))"
        parts.append(
            f"select cast({i - 1} as bigint) as batch_id, (select count(*) from {in_batch} b) as rows_in, "
            f"cast(0 as bigint) as rows_bad, (select count(*) from j{i} where t_id is null) as inserted, "
            f"(select count(*) from j{i} where upd) as updated, "
            f"(select count(*) from j{i} where t_id is not null and not coalesce(upd, false) "
            f"and s_id in (select order_id from {in_batch} c)) as unchanged, "
            f"(select max(status_ts) from {in_batch} d) as max_status_ts")
    return with_ctes(ctes, " union all ".join(parts))


def with_ctes(ctes: list[str], select: str) -> str:
    return "with " + ",\n".join(ctes) + "\n" + select


def status_chain_sql(variant: str, batches: Sequence[Sequence[int]], select: str | None = None,
                     cumulative: bool = True) -> str:
    ctes, last = merge_chain_ctes(batches, cumulative=cumulative)
    ctes = [f"fx as ({fx_events_sql(variant)})"] + ctes + [f"st as (select * from {last})"]
    return with_ctes(ctes, select or "select * from st")


def status_ordinal_sql(col: str) -> str:
    from orderpulse.schemas import STATUSES

    return "case " + " ".join(f"when {col} = '{s}' then {i}" for i, s in enumerate(STATUSES)) + " end"


def transition_class_sql(a: str, b: str) -> str:
    oa, ob = status_ordinal_sql(a), status_ordinal_sql(b)
    return (f"case when ({oa}) is null or ({ob}) is null then 'unknown' "
            f"when ({ob}) - ({oa}) = 0 then 'repeat' when ({ob}) - ({oa}) = 1 then 'forward' "
            f"when ({ob}) - ({oa}) > 1 then 'skip' else 'backward' end")


def hash_partition_sql(key: str, available) -> str:
    arr = "[" + ", ".join(str(p) for p in available) + "]"
    idx = f"cast((('0x' || substr(sha256({key}), 1, 16))::ubigint % {len(available)}) as bigint)"
    return f"case when {key} is null then {available[0]} else {arr}[{idx} + 1] end"


def customer_partition_sql(key: str, available) -> str:
    arr = "[" + ", ".join(str(p) for p in available) + "]"
    digits = f"regexp_replace({key}, '[^0-9]', '', 'g')"
    return (f"case when {key} is null then {available[0]} "
            f"when {digits} <> '' then {arr}[cast(cast({digits} as hugeint) % {len(available)} as bigint) + 1] "
            f"else {hash_partition_sql(key, available)} end")
