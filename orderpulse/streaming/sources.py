"""Streaming message sources and trigger presets.

The topic source needs the Kafka connector on the classpath; files of JSON
lines are the same stream shape (one ``value`` string per message) and are what
the tests drive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Flush size and interval of the micro-batches, merge schedule.
FLUSH_ROWS = 200
FLUSH_SECONDS = 10
MERGE_EVERY = "2 minutes"
#: Rows of one micro-batch at most, so that a backlog is worked off in bounded steps; a deployment setting.
MAX_ROWS = 5_000_000


def file_messages(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def kafka_options(bootstrap_servers: str, topic: str, starting_offsets: str = "latest", min_rows: int = FLUSH_ROWS,
                  max_delay_seconds: int = FLUSH_SECONDS, max_rows: int = MAX_ROWS, extra: dict | None = None) -> dict[str, str]:
    """A batch starts at ``min_rows`` messages or after ``max_delay_seconds``, whichever is first (with
    the ``arrival`` trigger), and holds at most ``max_rows``, also after a backlog."""
    return {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic, "startingOffsets": starting_offsets,
            "minOffsetsPerTrigger": str(min_rows), "maxTriggerDelay": f"{max_delay_seconds}s",
            "maxOffsetsPerTrigger": str(max_rows), **(extra or {})}


def kafka_messages(spark: SparkSession, bootstrap_servers: str, topic: str, reader=None, **options) -> DataFrame:
    """Topic source (see ``kafka_options``); the topic, partition and offset are carried along.

    Offsets live in the query checkpoint (committed after the batch succeeds),
    replacing consumer-group auto-commit.
    """
    reader = (reader or spark.readStream).format("kafka")
    for k, v in kafka_options(bootstrap_servers, topic, **options).items():
        reader = reader.option(k, v)
    return reader.load().select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset")


def trigger_options(kind: str) -> dict:
    """``flush``: every 10 s (file sources); ``arrival``: as soon as the source has a batch (a topic, whose
    options hold size and delay); ``schedule``: every 2 min; ``drain``: all there is, then stop."""
    if kind == "flush":
        return {"processingTime": f"{FLUSH_SECONDS} seconds"}
    if kind == "arrival":
        return {}
    if kind == "schedule":
        return {"processingTime": MERGE_EVERY}
    if kind == "drain":
        return {"availableNow": True}
    raise ValueError(f"unknown trigger {kind!r}")


def with_trigger(writer, kind: str):
    options = trigger_options(kind)
    return writer.trigger(**options) if options else writer
