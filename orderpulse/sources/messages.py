"""JSON messages <-> event rows.

Decoding is PERMISSIVE: malformed JSON, an absent required key, a null ``order_id`` or an
unparsable timestamp sends the message, text and all, to quarantine instead of stopping the pipeline.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderpulse.functions.scalars import iso_utc, parse_iso_utc, synthetic_event_id
from orderpulse.schemas import MESSAGE_SCHEMA

EVENT_COLUMNS = ["event_id", "order_id", "customer_id", "new_status", "status_ts", "source"]
# The keys that a message must have.
REQUIRED_KEYS = ["order_id", "customer_id", "new_status", "status_ts"]
CORRUPT = "_corrupt_record"


def encode_messages(events: DataFrame) -> DataFrame:
    """Event rows -> ``value`` JSON text (status_ts as ISO-8601 with +00:00)."""
    body = F.struct(
        F.col("event_id"), F.col("order_id"), F.col("customer_id"), F.col("new_status"),
        iso_utc(F.col("status_ts")).alias("status_ts"), F.col("source"))
    return events.select(F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
                         *[c for c in events.columns if c not in EVENT_COLUMNS])


def decode_messages(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text -> event columns plus ``_bad`` (reason) and ``_raw`` (the text) for rows to quarantine.

    A required key that is absent is bad; one that is there with a null is not, but for the
    key of the order. Other input columns (e.g. ``batch_id``, a topic's offset) are carried through.
    """
    schema = T.StructType(MESSAGE_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(value_col), schema,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    carry = [c for c in raw.columns if c != value_col]
    df = raw.select(parsed.alias("m"), F.col(value_col).alias("_raw"), *carry)
    ts = parse_iso_utc(F.col("m.status_ts"))
    event_id = F.coalesce(F.col("m.event_id"),
                          synthetic_event_id(*[F.col(f"m.{c}") for c in ("order_id", "customer_id", "new_status", "status_ts", "source")]))
    # the keys are read only from messages where a required one has no value
    lacks = F.greatest(*[F.col(f"m.{k}").isNull() for k in REQUIRED_KEYS])
    absent = F.when(lacks, F.array_except(F.array(*map(F.lit, REQUIRED_KEYS)),
                                          F.coalesce(F.json_object_keys("_raw"), F.array().cast("array<string>"))))
    bad = (F.when(F.col(f"m.{CORRUPT}").isNotNull() | F.col("m").isNull(), "malformed")
           .when(F.size(absent) > 0, F.concat(F.lit("missing "), F.element_at(absent, 1)))
           .when(F.col("m.order_id").isNull(), "missing order_id")
           .when(F.col("m.status_ts").isNotNull() & ts.isNull(), "bad status_ts"))
    return df.select(
        event_id.alias("event_id"), F.col("m.order_id").alias("order_id"),
        F.col("m.customer_id").alias("customer_id"), F.col("m.new_status").alias("new_status"),
        ts.alias("status_ts"), F.col("m.source").alias("source"), *carry, bad.alias("_bad"), "_raw")


def split_quarantine(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows as reason, text and what was carried through)."""
    good = decoded.where(F.col("_bad").isNull()).drop("_bad", "_raw")
    carried = [c for c in decoded.columns if c not in (*EVENT_COLUMNS, "_bad", "_raw")]
    bad = decoded.where(F.col("_bad").isNotNull()).select(
        F.col("_bad").alias("reason"), F.col("_raw").alias("value"), *carried)
    return good, bad
