"""Order-event views derived from the driver tables.

``events`` becomes a stream of order-status events, ``orders``/``part`` the raw
orders and inventory, ``customer`` the partition keys. Every view is a plain
projection/join of whole tables, so its cost grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.sources.tables import read_table

# event_type -> order status, and the number of arrival batches.
EVENT_TYPE_STATUS = {
    "signup": "CREATED",
    "purchase": "PAID",
    "view": "PACKED",
    "click": "SHIPPED",
    "error": "DELIVERED",
}
N_BATCHES = 5
BATCH_MULTIPLIER = 7919


def _status_of(event_type: Column) -> Column:
    expr = None
    for k, v in EVENT_TYPE_STATUS.items():
        expr = (F.when(event_type == k, v) if expr is None else expr.when(event_type == k, v))
    return expr


def fx_events(spark: SparkSession, sf_dir: str, variant: str = "base") -> DataFrame:
    """Status events: event_id, order_id, customer_id, new_status, status_ts, source, batch_id.

    Variants: ``day`` (status_ts truncated to the day), ``nulls`` (null ts where the
    source id % 97 = 0, null status where % 89 = 0), ``dup`` (rows with id % 50 = 0
    delivered twice).
    """
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "props"])
    src_id = F.col("event_id")
    ts = F.col("ts")
    status = _status_of(F.col("event_type"))
    if variant == "day":
        ts = F.to_date(ts).cast("timestamp_ntz")
    elif variant == "nulls":
        ts = F.when(src_id % 97 != 0, ts)
        status = F.when(src_id % 89 != 0, status)
    elif variant not in ("base", "dup"):
        raise ValueError(f"unknown fixture variant {variant!r}")
    out = ev.select(
        F.lpad(src_id.cast("string"), 12, "0").alias("event_id"),
        F.col("user_id").alias("order_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("customer_id"),
        status.alias("new_status"),
        ts.alias("status_ts"),
        F.lit("events").alias("source"),
        ((src_id * BATCH_MULTIPLIER) % N_BATCHES).cast("bigint").alias("batch_id"),
    )
    if variant == "dup":
        copies = out.where(F.col("event_id").cast("bigint") % 50 == 0)
        out = out.unionByName(copies)
    return out


def fx_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type", "p_retailprice"])
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
    )


def product_range(spark: SparkSession, sf_dir: str) -> int:
    """Product ids of the order lines run up to a tenth past the parts there are, at every size: most
    parts are looked up, and about one line in eleven takes the fallback price."""
    return max(1, read_table(spark, sf_dir, "part", ["p_partkey"]).count() * 11 // 10)


def fx_order_lines(spark: SparkSession, sf_dir: str, partial: bool = False) -> DataFrame:
    """Orders before pricing: order_id, customer_id, product_id, quantity, sold_at, fallback_price."""
    cols = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]
    orders = read_table(spark, sf_dir, "orders", cols + (["o_orderstatus"] if partial else []))
    if partial:
        orders = orders.where(F.col("o_orderstatus").isNull() | (F.col("o_orderstatus") != "F"))
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        (F.col("o_orderkey") % product_range(spark, sf_dir)).alias("product_id"),
        (F.col("o_orderkey") % 5 + 1).alias("quantity"),
        F.col("o_orderdate").alias("sold_at"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("fallback_price"),
    )


def fx_orders(spark: SparkSession, sf_dir: str, partial: bool = False) -> DataFrame:
    """Raw orders, priced from the inventory with the order's own price as fallback."""
    from orderpulse.operators.enrich import enrich_price

    lines = fx_order_lines(spark, sf_dir, partial)
    priced = enrich_price(lines, fx_inventory(spark, sf_dir), F.col("fallback_price"))
    return normalize_order_columns(priced)


# The order columns in table order; loads may name them in upper case.
ORDER_COLUMNS = ["order_id", "customer_id", "product_id", "quantity", "unit_price", "order_total", "sold_at"]
ORDER_COLUMN_RENAMES = {c.upper(): c for c in ORDER_COLUMNS}


def normalize_order_columns(df: DataFrame) -> DataFrame:
    """Rename by map (absent names are ignored) and put the columns in table order."""
    return df.withColumnsRenamed(ORDER_COLUMN_RENAMES).select(*ORDER_COLUMNS)


def existing_orders_sample(orders: DataFrame, n: int = 20) -> DataFrame:
    """The producer's pick of existing orders: (order_id, customer_id), first ``n`` by id."""
    return orders.select("order_id", "customer_id").orderBy("order_id").limit(n)


def fx_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message keys: one per customer, plus the edge cases (no digits, empty, null)."""
    cust = read_table(spark, sf_dir, "customer", ["c_custkey"])
    keys = cust.select(F.concat(F.lit("customer:"), F.col("c_custkey").cast("string")).alias("key"))
    edge = spark.createDataFrame([("abc",), ("",), (None,)], "key string")
    return keys.unionByName(edge)

