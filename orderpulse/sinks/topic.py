"""Publishing events as JSON messages: to a Kafka topic, or to JSON-line files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse.functions.partitioning import hash_partition
from orderpulse.sources.messages import encode_messages


def with_event_ids(events: DataFrame) -> DataFrame:
    """Give messages without an id a fresh UUID (ids are assigned once, at publish time)."""
    return events.withColumn("event_id", F.coalesce(F.col("event_id"), F.expr("uuid()")))


def publish_files(events: DataFrame, path: str) -> None:
    """Append messages as JSON lines to ``path`` (the file-source stand-in for a topic)."""
    encode_messages(events.drop("batch_id")).select("value").write.mode("append").text(path)


def kafka_rows(events: DataFrame, key_col: str | None = None, available_partitions: list[int] | None = None) -> DataFrame:
    """Rows for the topic sink: value, with ``key_col`` a key, with ``available_partitions`` an explicit
    ``partition`` by the hash partitioner."""
    src = events.drop("batch_id")
    if key_col:
        src = src.withColumn("_key", F.col(key_col).cast("string"))
    cols = [F.col("value")]
    if key_col:
        cols.append(F.col("_key").alias("key"))
        if available_partitions:
            cols.append(hash_partition(F.col("_key"), available_partitions).alias("partition"))
    return encode_messages(src).select(*cols)


def publish_kafka(events: DataFrame, bootstrap_servers: str, topic: str, key_col: str | None = None,
                  available_partitions: list[int] | None = None, writer=None) -> None:
    """Batch-publish messages to a topic (needs the Kafka connector on the classpath)."""
    rows = kafka_rows(events, key_col, available_partitions)
    ((writer or rows.write).format("kafka")
     .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic).save())
