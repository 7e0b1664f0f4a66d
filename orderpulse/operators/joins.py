"""Join helpers: broadcast only behind a measured size bound."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FALLBACK_BROADCAST_BYTES = 10 * 1024 * 1024


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def parse_bytes(text: str) -> int:
    """Spark size strings: ``10485760``, ``10485760b``, ``10MB``, ``-1``."""
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", str(text))
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"not a size: {text!r}")
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def _threshold(df: DataFrame) -> int:
    raw = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    try:
        value = parse_bytes(raw)
    except ValueError:
        value = FALLBACK_BROADCAST_BYTES
    return value if value > 0 else 0


def size_bound_bytes(df: DataFrame) -> int | None:
    """Upper bound of the in-memory size of ``df``, measured (one aggregate pass); None where a
    column's size isn't bounded by what is measured (arrays, maps, structs, ...).

    Each row costs null-bitset words plus one 8-byte slot per column; strings and
    binaries add their byte length rounded up to whole 8-byte words, wide decimals 16 bytes.
    """
    fields = df.schema.fields
    if not all(isinstance(f.dataType, (T.StringType, T.BinaryType, T.NumericType, T.BooleanType, T.DateType,
                                       T.TimestampType, T.TimestampNTZType)) for f in fields):
        return None
    var = [f.name for f in fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    aggs = [F.count(F.lit(1)).alias("rows")]
    if var:
        words = sum((F.ceil(F.coalesce(F.octet_length(F.col(c)), F.lit(0)) / 8) for c in var), F.lit(0))
        aggs.append((F.sum(words) * 8).cast("long").alias("var_bytes"))
    row = df.agg(*aggs).first()
    rows = row["rows"]
    var_bytes = (row["var_bytes"] or 0) if var else 0
    wide = sum(16 for f in fields if isinstance(f.dataType, T.DecimalType) and f.dataType.precision > 18)
    return rows * (8 * -(-len(fields) // 64) + 8 * len(fields) + wide) + var_bytes


def sized_broadcast(small: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``broadcast(small)`` when its measured size is within the bound, else ``small``.

    Beyond the bound the join stays a shuffle join and AQE decides at run time.
    """
    limit = _threshold(small) if max_bytes is None else max_bytes
    if limit <= 0:
        return small
    bound = size_bound_bytes(small)
    return F.broadcast(small) if bound is not None and bound <= limit else small


def combine_one_row(*frames: DataFrame) -> DataFrame:
    """Side-by-side columns of several one-row frames, without a cross join.

    Each frame is padded with typed nulls to the union of columns, the frames are
    stacked (``unionByName``) and collapsed with a global ``max`` (ignores nulls),
    so every input is computed exactly once.
    """
    fields = [f for df in frames for f in df.schema.fields]
    padded = [df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                          for f in fields]) for df in frames]
    stacked = padded[0]
    for df in padded[1:]:
        stacked = stacked.unionByName(df)
    return stacked.agg(*[F.max(f.name).alias(f.name) for f in fields])
