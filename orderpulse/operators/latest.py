"""Latest event per key: ``ROW_NUMBER() OVER (PARTITION BY key ORDER BY ts DESC, id DESC) = 1``.

Ordering is always (ts desc nulls last, tie desc nulls last). Both plans reduce
map-side before the shuffle, so a key holding a large share of the rows costs
one row per map partition, not a hot reducer:

* ``max_struct``: ``max(struct(ts, tie, payload...))`` -> partial + final aggregate.
  Struct ordering compares field by field with nulls smallest, which is exactly
  "desc nulls last" for a max.
* ``window``: row_number with ``rn = 1``; Catalyst inserts a partial
  ``WindowGroupLimit`` before the exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LATEST_PAYLOAD = ["customer_id", "new_status"]


def latest_per_key(df: DataFrame, key: str | list[str] = "order_id", ts: str = "status_ts",
                   tie: str = "event_id", payload: list[str] | None = None,
                   method: str = "max_struct") -> DataFrame:
    """One row per ``key``: (key, ts, tie, *payload) of its latest event."""
    payload = LATEST_PAYLOAD if payload is None else payload
    cols = [ts, tie, *payload]
    keys = [key] if isinstance(key, str) else list(key)
    if method == "max_struct":
        best = F.max(F.struct(*[F.col(c) for c in cols])).alias("_latest")
        return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in cols])
    if method == "max_by":
        order = F.struct(F.col(ts), F.col(tie))
        best = F.max_by(F.struct(*[F.col(c) for c in cols]), order).alias("_latest")
        return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in cols])
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(F.col(ts).desc_nulls_last(), F.col(tie).desc_nulls_last())
        return (df.select(*keys, *cols).withColumn("_rn", F.row_number().over(w))
                .where(F.col("_rn") == 1).drop("_rn"))
    raise ValueError(f"unknown method {method!r}")


def latest_status(events: DataFrame, method: str = "max_struct") -> DataFrame:
    """Merge source: order_id, event_id, customer_id, new_status, last_event_ts."""
    latest = latest_per_key(events, method=method)
    return latest.select("order_id", "event_id", "customer_id", "new_status",
                         F.col("status_ts").alias("last_event_ts"))
