"""Reconciliation of two tables by digests: only the buckets that differ are compared in full.

A bucket's digest is its row count and two sums of row hashes, which no order of rows and no split into tasks
changes; both are partial aggregates, so a digest costs one scan and an exchange of a few rows a task.
Rows hash with their null marks, since a null leaves a hash as it is. Equal digests are taken for
equal buckets (two sums of 32-bit halves must agree by chance otherwise).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse.schemas import STATUS_COLUMNS

BUCKETS = 256


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def digests(df: DataFrame, key: str, columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n, low, high)."""
    h = F.xxhash64(*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns])
    rows = df.select(bucket_of(key, buckets).alias("bucket"), h.alias("_h"))
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_h").bitwiseAND(0xFFFFFFFF)).alias("low"),
                                      F.sum(F.shiftrightunsigned("_h", 32)).alias("high"))


def differing_buckets(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str], buckets: int = BUCKETS) -> list[int]:
    """Buckets whose digests differ: at most ``buckets`` numbers."""
    a, b = (digests(t, key, columns, buckets) for t in (left, right))
    both = a.alias("a").join(b.alias("b"), F.col("a.bucket") == F.col("b.bucket"), "full_outer")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("n", "low", "high")])
    return sorted(r["bucket"] for r in both.where(~same).select(F.coalesce("a.bucket", "b.bucket").alias("bucket")).collect())


def differences(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, kind, left, right): rows of either table that the other lacks or has otherwise; each key is in a table
    once. ``kind``: missing (not in ``right``), extra (not in ``left``) or changed; the rows as structs."""
    def side(df, name):
        return df.select(F.col(key).alias(f"_{name}_key"), F.struct(*columns).alias(f"_{name}"))

    both = side(left, "left").join(side(right, "right"), F.col("_left_key").eqNullSafe(F.col("_right_key")), "full_outer")
    kind = (F.when(F.col("_right").isNull(), "missing").when(F.col("_left").isNull(), "extra")
            .when(~F.col("_left").eqNullSafe(F.col("_right")), "changed"))
    return both.withColumn("kind", kind).where("kind is not null").select(
        F.coalesce("_left_key", "_right_key").alias(key), "kind", F.col("_left").alias("left"), F.col("_right").alias("right"))


def reconcile(left: DataFrame, right: DataFrame, key: str = "order_id", columns: Sequence[str] = STATUS_COLUMNS,
              buckets: int = BUCKETS) -> DataFrame:
    """``differences`` of two tables; rows of buckets with equal digests go no further than the scan."""
    found = differing_buckets(left, right, key, columns, buckets)
    keep = bucket_of(key, buckets).isin(found) if found else F.lit(False)
    return differences(left.where(keep), right.where(keep), key, columns)


def reconcile_stores(left, right, columns: Sequence[str] = STATUS_COLUMNS) -> DataFrame:
    """``differences`` of the status in two stores with one bucket count: of buckets with equal digests no file
    is opened again."""
    a, b = left.latest_commit(), right.latest_commit()
    n = left.buckets(a)
    if a is None or b is None or right.buckets(b) != n:
        return reconcile(left.read_status(), right.read_status(), "order_id", columns, n)
    found = differing_buckets(left.read_state(commit=a), right.read_state(commit=b), "order_id", columns, n)
    return differences(left.read_state(commit=a, only=found), right.read_state(commit=b, only=found), "order_id", columns)
