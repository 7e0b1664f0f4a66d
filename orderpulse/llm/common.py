"""Helpers shared by the training-data operators."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.session import scratch_path, ship_package

#: Bytes mapped to a space when words are runs of 0-9, a-z and non-ASCII (after ASCII lower-casing).
_WORD_TABLE = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """A table of the given folder, pruned to ``cols`` when any are given."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage, survives
    the loss of executors, and fixes the order-dependent choices of what made it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as make them new to the columns of ``df``."""
    taken, prefix = {c.lower() for c in df.columns}, ""
    while any((prefix + n).lower() in taken for n in names):
        prefix += "_"
    return [prefix + n for n in names]


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """While this holds, at most so many rows travel to Python at once: for jobs over large rows that
    run inside the block."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shipped(df: DataFrame) -> DataFrame:
    """``df``, after making this package importable in the Python workers."""
    ship_package(df.sparkSession)
    return df


def row_hash(text: str = "text") -> Column:
    """Tells apart rows that carry the same id and different texts."""
    return F.xxhash64(F.col(text))


def alnum_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().translate(_WORD_TABLE).split() if text else []


def space_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): for every node of an edge, the smallest node it can reach.

    Large-star / small-star rounds: every round replaces edges by edges towards smaller nodes,
    until the forest is stars around the smallest nodes. Each star is a grouped minimum (partial
    aggregation) joined back to the edges, so a node with very many links is summed before the
    shuffle and its join partition can be split. Every round is written to the shared folder.
    """
    spark = edges.sparkSession

    def canonical(df: DataFrame) -> DataFrame:
        return df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def star(df: DataFrame, large: bool) -> DataFrame:
        # df: (u > v). Large star: links of u's neighbours above u; small star: those not above u.
        both = df.unionByName(df.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else df
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.join(low, "u")
        if large:
            return out.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return out.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    current = stored(canonical(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "links")
    now = state(current)
    while now[0]:
        current = stored(canonical(star(canonical(star(current, True)), False)), "links")
        before, now = now, state(current)
        if now == before:
            break
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
