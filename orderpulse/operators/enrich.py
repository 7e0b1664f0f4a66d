"""Price lookup and price banding."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse.functions.scalars import clamp, money
from orderpulse.operators.joins import sized_broadcast

# Base price per category and the band around it.
CATEGORY_BASE_PRICE = {"Apparel": 39, "Electronics": 299, "Home & Kitchen": 79, "Beauty": 25, "Grocery": 12}
BAND_LOW, BAND_HIGH = 0.4, 1.8


def enrich_price(lines: DataFrame, inventory: DataFrame, fallback: Column) -> DataFrame:
    """Look up ``unit_price`` by ``product_id``; fall back when the product is unknown.

    Adds ``unit_price`` decimal(10,2) and ``order_total = quantity * unit_price`` decimal(12,2).
    The inventory is broadcast only if its measured size is under the threshold.
    """
    prices = inventory.select("product_id", F.col("unit_price").alias("_inv_price"))
    joined = lines.join(sized_broadcast(prices), "product_id", "left")
    unit_price = money(F.coalesce(F.col("_inv_price"), fallback), 10)
    return (joined.withColumn("unit_price", unit_price)
            .withColumn("order_total", money(F.col("quantity") * F.col("unit_price"), 12))
            .drop("_inv_price"))


def category_base_prices(inventory: DataFrame) -> DataFrame:
    """Base price per category from the data: mean unit price, rounded half-up to cents.

    Computed in integer cents so the rounding is exact (no floating average).
    """
    cents = (F.col("unit_price") * 100).cast("bigint")
    agg = inventory.groupBy("category").agg(F.sum(cents).alias("_c"), F.count("unit_price").alias("_n"))
    base_cents = F.expr("(2 * _c + _n) div (2 * _n)")
    return agg.select("category", (base_cents.cast("decimal(20,0)") / 100).cast("decimal(10,2)").alias("base_price"))


def price_band(inventory: DataFrame, base_prices: DataFrame | dict | None = None) -> DataFrame:
    """Clamp each product's price into [0.4, 1.8] x its category's base price.

    ``base_prices`` is a (category, base_price) frame, a dict, or None for the
    data-derived base. The per-category table has one row per category, so it
    is joined with a measured broadcast.
    """
    if base_prices is None:
        base = category_base_prices(inventory)
    elif isinstance(base_prices, dict):
        spark = inventory.sparkSession
        base = spark.createDataFrame([(k, float(v)) for k, v in base_prices.items()],
                                     "category string, base_price double")
        base = base.select("category", money(F.col("base_price"), 10).alias("base_price"))
    else:
        base = base_prices
    low = money(F.col("base_price") * F.lit(Decimal(str(BAND_LOW))), 10)
    high = money(F.col("base_price") * F.lit(Decimal(str(BAND_HIGH))), 10)
    out = inventory.join(sized_broadcast(base), "category", "left")
    return out.select(
        "product_id", "category", "unit_price", "base_price",
        low.alias("band_low"), high.alias("band_high"),
        clamp(F.col("unit_price"), low, high).alias("banded_price"),
        F.concat_ws(" ", F.col("category"), F.col("product_name")).alias("product_label"),
    )
