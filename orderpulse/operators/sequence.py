"""Previous row within a key's ordered sequence, without a hot reducer.

``lag() OVER (PARTITION BY key ORDER BY ...)`` sends a whole key to one task; a
key holding a third of all rows makes that task a third of the job. Here:

1. ``repartitionByRange(key, order...)`` + ``sortWithinPartitions``: balanced,
   contiguous runs of the global order; a hot key spans several partitions.
   Written as a reliable checkpoint together with the range partition's number,
   so neither depends on which task reads a row later.
2. Partition tails: the last row of each partition -- at most one row per
   partition, a bound set by the partition count, not the data.
3. ``mapInArrow`` over the same rows (no further shuffle): the previous row is the
   row above when it has the same key; a partition's first row takes the tail of
   the nearest non-empty partition before it, if the key matches. Values are moved
   as Arrow arrays, so every type keeps its exact values.

Order is ascending with nulls first, on (order...) within the key. The checkpoint
goes with the frame that reads it where ``spark.cleaner.referenceTracking.cleanCheckpoints``
is set.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderpulse.session import checkpoint_root, ship_package

_PID = "_range_partition"


def _same(a: pa.Array, b: pa.Array) -> pa.Array:
    """Element-wise equality where null == null (keys group nulls together)."""
    return pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))


def with_previous(df: DataFrame, key: str, order_cols: Sequence[str], value_cols: Sequence[str],
                  num_partitions: int | None = None, prefix: str = "prev_") -> DataFrame:
    """Adds ``prev_<v>`` for each value column and ``has_prev``."""
    spark = df.sparkSession
    checkpoint_root(spark)
    ship_package(spark)
    order_cols, value_cols = list(order_cols), list(value_cols)
    keep = list(dict.fromkeys([key, *order_cols, *value_cols, *df.columns]))
    by = [key, *order_cols]
    rows = df.select(*keep)
    ranged = rows.repartitionByRange(num_partitions, *by) if num_partitions else rows.repartitionByRange(*by)
    ranged = (ranged.sortWithinPartitions(*by).withColumn(_PID, F.spark_partition_id())
              .checkpoint(eager=True))

    # Struct max = last row in (key, order...) order, nulls lowest, as sorted above.
    tail_fields = [key, *value_cols]
    tails = (ranged.groupBy(_PID)
             .agg(F.max(F.struct(*[F.col(c) for c in [key, *order_cols, *value_cols]])).alias("_t"))
             .select(_PID, *[F.col(f"_t.{c}").alias(c) for c in tail_fields])
             .orderBy(_PID).toArrow())  # one row per non-empty partition
    pids = tails.column(_PID).to_pylist()
    tails = tails.select(tail_fields).combine_chunks()
    before_of = {pid: i - 1 for i, pid in enumerate(pids)}  # row of ``tails`` that precedes a partition

    out_schema = T.StructType(
        [ranged.schema[c] for c in keep]
        + [T.StructField(f"{prefix}{v}", ranged.schema[v].dataType, True) for v in value_cols]
        + [T.StructField("has_prev", T.BooleanType(), False)])
    names = [*keep, *(f"{prefix}{v}" for v in value_cols), "has_prev"]

    def shifted(batch: pa.RecordBatch, first: dict[str, pa.Array]) -> pa.RecordBatch:
        """One run of rows of one range partition; ``first``: what precedes its first row."""
        def above(c):
            col = batch.column(c)
            head = first[c].cast(col.type) if c in first else pa.nulls(1, col.type)
            return pa.concat_arrays([head, col.slice(0, len(col) - 1)])

        has = _same(batch.column(key), above(key))
        if not first:
            has = pa.concat_arrays([pa.array([False]), has.slice(1)])
        prev = [pc.if_else(has, above(v), pa.nulls(batch.num_rows, batch.column(v).type)) for v in value_cols]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *prev, has], names)

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, first = None, {}
        for batch in batches:
            at, pid_col = 0, batch.column(_PID).to_pylist()
            while at < batch.num_rows:
                pid = pid_col[at]
                end = at + 1
                while end < batch.num_rows and pid_col[end] == pid:
                    end += 1
                if pid != current:
                    i, current = before_of[pid], pid
                    first = {c: tails.column(c).combine_chunks().slice(i, 1) for c in tail_fields} if i >= 0 else {}
                    first = {c: a.chunk(0) if isinstance(a, pa.ChunkedArray) else a for c, a in first.items()}
                run = batch.slice(at, end - at)
                yield shifted(run, first)
                first = {c: run.column(c).slice(run.num_rows - 1, 1) for c in tail_fields}
                at = end

    return ranged.mapInArrow(per_partition, out_schema)


def with_previous_window(df: DataFrame, key: str, order_cols: Sequence[str], value_cols: Sequence[str],
                         prefix: str = "prev_") -> DataFrame:
    """Plain window version (one task per key); for keys known to be small."""
    w = Window.partitionBy(key).orderBy(*order_cols)
    out = df
    for v in value_cols:
        out = out.withColumn(f"{prefix}{v}", F.lag(v).over(w))
    return out.withColumn("has_prev", F.row_number().over(w) > 1)
