"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

Every document of a source expects ``target / source size`` copies. Within its source the expected
copies are prefix-summed in a fixed order, one random offset is added, and a document is emitted
once for every whole number that its interval crosses; so its copies are the expected number
rounded down or up. The order runs by the five leading bits of the size, then by a hash of the id, then
by size: a sample taken at even steps then holds every size in proportion, and its words come near the
target.

The prefix sum has two levels: sums of blocks (source, leading bits, hash prefix: some ten thousands a
source, however many rows it has), added up over the blocks of a source, then a window inside each block. A
source with a third of all rows is spread over its blocks. Expected copies are whole multiples of
2^-24, so sums are exact and reruns agree.

Defined cases: a null or empty text has size 0, and its copies count no words; null is a source of
its own (the last); a null id sorts first; rows that are equal in every column are interchangeable;
a source without words has target 0 and gives no copies; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderpulse.llm.common import free_names

WEIGHTS = (5, 2, 1)
MAX_RATE = 3
UNIT = 1 << 24
SEED = 42
_MADE = ("_size", "_source_size", "_target", "_copies")


def text_size(text: str = "text") -> Column:
    r"""Number of words ``[^\x20\x09-\x0D]+``; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sized: DataFrame, source: str = "source", size: str = "_size", weights=WEIGHTS,
                   max_rate: int = MAX_RATE) -> DataFrame:
    """(source, source_size, target): sources by code point, null last, weigh ``weights`` in turn and
    share the total size; what exceeds ``max_rate`` times a source's size is shared by weight among
    the others until none exceeds it. Reading sources by size over weight, the capped ones come
    first: the share per weight of the others is what is left over their weights."""
    by_source = sized.groupBy(F.col(source).alias("source")).agg(F.sum(size).cast("bigint").alias("source_size"))
    order = W.orderBy(F.col("source").isNull(), "source")
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1))
    rows = by_source.withColumn("weight", turn.cast("bigint"))
    ranked = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    before, after = ranked.rowsBetween(W.unboundedPreceding, -1), ranked.rowsBetween(0, W.unboundedFollowing)
    total = F.sum("source_size").over(W.partitionBy())
    share = ((total - max_rate * F.coalesce(F.sum("source_size").over(before), F.lit(0))).cast("double")
             / F.sum("weight").over(after).cast("double"))
    rows = rows.withColumn("share", share)
    free = F.col("share") * F.col("weight") <= F.col("source_size") * max_rate
    per_weight = F.coalesce(F.min(F.when(free, F.struct(F.col("source_size") / F.col("weight"),
                                                        F.col("source").isNull(), "source", "share")))
                            .over(W.partitionBy())["share"], F.lit(float("inf")))
    cap = (F.col("source_size") * max_rate).cast("double")
    return rows.withColumn("per_weight", per_weight).select(
        "source", "source_size", F.least(F.col("per_weight") * F.col("weight"), cap).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, max_rate: int = MAX_RATE, seed: int = SEED) -> DataFrame:
    """``docs`` and, last, ``_size``, ``_source_size``, ``_target`` and ``_copies`` (with further underscores where
    ``docs`` has such a column), each column of ``docs`` unchanged. Only the columns that are asked for
    later pass the shuffle."""
    inner = [f"c{i}" for i in range(len(docs.columns))]  # no clash with the columns that are made on the way
    at = {c.lower(): i for c, i in zip(docs.columns, inner)}
    mixed = _mix(docs.toDF(*inner), at[id_col.lower()], at[text_col.lower()], at[source_col.lower()], weights, max_rate, seed)
    return mixed.select(*[F.col(i).alias(c) for i, c in zip(inner, docs.columns)],
                        *[F.col(r).alias(n) for r, n in zip(_MADE, free_names(docs, *_MADE))])


def _mix(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights, max_rate: int, seed: int) -> DataFrame:
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = docs.withColumns({"_size": text_size(text_col), "_salt": F.substring(F.md5(key), 1, 2), "_tie": F.md5(text_col)})
    octave = F.length(F.bin("_size"))
    # bits of the size, and the five leading ones: sizes of a block differ by a sixteenth at most
    rows = rows.withColumn("_bits", octave * 32 + F.call_function("shiftright", F.col("_size"), F.greatest(octave - 5, F.lit(0))))
    targets = source_targets(rows, source_col, "_size", weights, max_rate).withColumn(
        "_each", F.coalesce(F.floor(F.try_divide(F.col("target") * UNIT, F.col("source_size"))), F.lit(0)).cast("bigint"))
    block = [F.col(source_col).alias("source"), "_bits", "_salt"]
    blocks = rows.groupBy(*block).agg(F.count("*").alias("n"))
    # sources are few beside rows, and so are blocks: some thousands a source
    blocks = blocks.join(targets, blocks.source.eqNullSafe(targets.source)).select(
        blocks.source.alias("_b_source"), F.col("_bits").alias("_b_bits"), F.col("_salt").alias("_b_salt"),
        F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), "_each", "n")
    label = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_b_source"), F.lit("")))
    offset = F.conv(F.substring(F.md5(label), 1, 6), 16, 10).cast("bigint")  # 24 bits: one unit at most
    so_far = W.partitionBy("_b_source").orderBy("_b_bits", "_b_salt").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", offset + F.coalesce(F.sum(F.col("n") * F.col("_each")).over(so_far), F.lit(0))).drop("n")
    rows = rows.join(blocks, rows[source_col].eqNullSafe(blocks._b_source) & (rows._bits == blocks._b_bits)
                     & (rows._salt == blocks._b_salt)).drop("_b_source", "_b_bits", "_b_salt")
    inside = W.partitionBy(source_col, "_bits", "_salt").orderBy("_size", id_col, "_tie")
    end = F.col("_before") + F.row_number().over(inside) * F.col("_each")
    copies = F.expr(f"_end div {UNIT} - (_end - _each) div {UNIT}")
    return rows.withColumn("_end", end).withColumn("_copies", copies).drop("_end", "_before", "_each", "_bits", "_salt", "_tie")


def emit(mixed: DataFrame) -> DataFrame:
    """Each row of ``mix`` as often as its copies say, with the columns of the documents alone (all but the last four)."""
    *columns, copies = (F.col(f"`{c}`") for c in mixed.columns)
    (copy,) = free_names(mixed, "_copy")
    rows = mixed.where(copies > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), copies.cast("int"))))
    return rows.select(columns[:len(columns) + 1 - len(_MADE)])
