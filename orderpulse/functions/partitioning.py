"""Partition-assignment columns for message keys.

``hash_partition``: first 8 bytes of SHA-256(key) as an unsigned big-endian
integer, modulo the number of available partitions, mapped through the list.
``customer_partition``: the key's digits as an integer modulo n (all ASCII digits
anywhere in the key, concatenated); keys without digits fall back to the hash.
A null key goes to the first available partition; with none available, 0.

The result can feed a Kafka sink's ``partition`` column or, with ``placed``, Spark's own partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGIT_CHUNK = 18  # decimal digits per step of the modular fold; fits decimal(38,0)


def _mapped(index: Column, available: Sequence[int]) -> Column:
    return F.element_at(F.array(*[F.lit(int(p)) for p in available]), (index + 1).cast("int"))


def sha256_prefix_mod(key: Column, n: int) -> Column:
    """(first 8 bytes of sha256(key) as unsigned int64) % n."""
    prefix = F.conv(F.substring(F.sha2(key, 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return (prefix % F.lit(n)).cast("bigint")


def digits_mod(digits: Column, n: int) -> Column:
    """Exact ``int(digits) % n`` for digit strings of any length (18-digit modular fold)."""
    chunks = F.regexp_extract_all(digits, F.lit(r"(\d{1,%d})" % DIGIT_CHUNK), 1)
    zero = F.lit(0).cast("decimal(38,0)")

    def step(acc, chunk):
        scale = F.pow(F.lit(10), F.length(chunk)).cast("decimal(38,0)")
        return ((acc * scale + chunk.cast("decimal(38,0)")) % F.lit(n)).cast("decimal(38,0)")

    return F.aggregate(chunks, zero, step).cast("bigint")


def hash_partition(key: Column, available: Sequence[int]) -> Column:
    if not available:
        return F.lit(0)
    return F.when(key.isNull(), F.lit(int(available[0]))).otherwise(
        _mapped(sha256_prefix_mod(key, len(available)), available))


def key_digits(key: Column) -> Column:
    return F.regexp_replace(key, "[^0-9]", "")


def customer_partition(key: Column, available: Sequence[int]) -> Column:
    if not available:
        return F.lit(0)
    digits = key_digits(key)
    by_digits = _mapped(digits_mod(digits, len(available)), available)
    return F.when(key.isNull(), F.lit(int(available[0]))) \
            .when(digits != "", by_digits) \
            .otherwise(hash_partition(key, available))


def placed(df: DataFrame, partition: str, available: Sequence[int]) -> DataFrame:
    """Rows moved to the partition whose number their column names, one Spark partition for each of
    0 to the greatest available number: no second hash, so two frames placed alike lie alike."""
    return df.repartitionById(max(available, default=0) + 1, F.col(partition).cast("int"))
