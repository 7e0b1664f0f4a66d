"""State and progress of a streaming query as tables, read from its checkpoint: the query need not run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATE_SCHEMA = "operator_id bigint, operator_name string, state_store string, partitions int, min_batch bigint, max_batch bigint, state_rows bigint"


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row a state store of the query: its operator, partitions and the batches it can be read at."""
    return spark.read.format("state-metadata").load(checkpoint).select(
        F.col("operatorId").alias("operator_id"), F.col("operatorName").alias("operator_name"), F.col("stateStoreName").alias("state_store"),
        F.col("numPartitions").alias("partitions"), F.col("minBatchId").alias("min_batch"), F.col("maxBatchId").alias("max_batch"))


def state_rows(spark: SparkSession, checkpoint: str, operator_id: int = 0, state_store: str = "default") -> DataFrame:
    """(key, value, partition_id) of every row in a state store after the newest batch."""
    return (spark.read.format("statestore").option("operatorId", operator_id).option("storeName", state_store).load(checkpoint))


def state_summary(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The operators with the number of rows that each keeps; a query has a few operators."""
    found = state_operators(spark, checkpoint).collect()
    each = [state_rows(spark, checkpoint, r["operator_id"], r["state_store"]).agg(F.count(F.lit(1)).alias("state_rows")).select(
        *[F.lit(r[c]).alias(c) for c in ("operator_id", "operator_name", "state_store", "partitions", "min_batch", "max_batch")], "state_rows")
        for r in found]
    return reduce(DataFrame.unionByName, each) if each else spark.createDataFrame([], STATE_SCHEMA)
