"""The raw event table: append by arrival batch, idempotently.

Layout: ``<root>/batch_id=<n>/part-*.parquet``. Re-landing a batch (a replayed
micro-batch after a failure) overwrites exactly that partition, so replays
never duplicate rows. Readers prune by ``batch_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderpulse.schemas import EVENT_SCHEMA

RAW_COLUMNS = [f.name for f in EVENT_SCHEMA.fields]
RAW_SCHEMA = T.StructType(EVENT_SCHEMA.fields + [T.StructField("batch_id", T.LongType())])


def assert_schema(df: DataFrame, expected=EVENT_SCHEMA) -> None:
    got = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in expected.fields if f.name not in got]
    wrong = [f.name for f in expected.fields if f.name in got and got[f.name] != f.dataType]
    if missing or wrong:
        raise ValueError(f"raw schema mismatch: missing={missing} wrong_type={wrong}")


def land_batch(events: DataFrame, root: str, batch_id: int) -> None:
    """Write one arrival batch as partition ``batch_id``; replaces it if it exists."""
    assert_schema(events)
    (events.select(*RAW_COLUMNS).write.mode("overwrite")
     .parquet(f"{root.rstrip('/')}/batch_id={int(batch_id)}"))


def read_batch(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    """One landed batch, read from its own partition folder: no listing of the other
    batches (which grow with the stream's age)."""
    return (spark.read.schema(EVENT_SCHEMA).parquet(f"{root.rstrip('/')}/batch_id={int(batch_id)}")
            .withColumn("batch_id", F.lit(int(batch_id)).cast("bigint")))


def read_batches(spark: SparkSession, root: str, batch_ids) -> DataFrame:
    """Some landed batches, each from its own folder (no listing of the others)."""
    root = root.rstrip("/")
    paths = [f"{root}/batch_id={int(b)}" for b in batch_ids]
    if not paths:
        return spark.createDataFrame([], RAW_SCHEMA)
    return spark.read.option("basePath", root).schema(RAW_SCHEMA).parquet(*paths)


def read_raw(spark: SparkSession, root: str, batch_ids=None) -> DataFrame:
    df = spark.read.schema(RAW_SCHEMA).parquet(root)
    if batch_ids is not None:
        df = df.where(F.col("batch_id").isin(list(batch_ids)))
    return df


def unconsumed(raw: DataFrame, last) -> DataFrame:
    """Raw rows that are not yet merged (the change-stream peek): the batches after the commit ``last``
    of the run log (none: all), a literal that prunes partitions."""
    return raw if last is None else raw.where(F.col("batch_id") > F.lit(last.batch_id))
