"""Table lifecycle: databases, typed empty tables, overwrite loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from orderpulse.session import path_exists


def ensure_database(spark: SparkSession, name: str) -> None:
    """``CREATE DATABASE IF NOT EXISTS``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def table_exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType, replace: bool = False) -> DataFrame:
    """Typed parquet table at ``path``: created empty if absent, recreated if ``replace``
    (``CREATE OR REPLACE TABLE``). Returns the table."""
    if replace or not table_exists(spark, path):
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)


def load_table(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    """Overwrite-load a frame; with ``schema`` the columns are cast and ordered to it first."""
    if schema is not None:
        df = df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    df.write.mode("overwrite").parquet(path)


def append_table(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Append to an existing table; the frame must already have the table's schema
    (no auto-create, no silent casts)."""
    if not table_exists(df.sparkSession, path):
        raise ValueError(f"table {path} does not exist")
    want = [(f.name, f.dataType) for f in schema.fields]
    got = [(f.name, f.dataType) for f in df.schema.fields]
    if got != want:
        raise ValueError(f"schema mismatch: {got} != {want}")
    df.write.mode("append").parquet(path)
