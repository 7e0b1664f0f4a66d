"""Declared schemas and the status domain.

Schemas are always explicit: no inference on read.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The status domain, in lifecycle order.
STATUSES = ["CREATED", "PAID", "PACKED", "SHIPPED", "DELIVERED"]

# Wire message (one JSON object per topic message). Times travel as ISO-8601 text.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("new_status", T.StringType()),
    T.StructField("status_ts", T.StringType()),
    T.StructField("source", T.StringType()),
])

# Raw status events as landed (plus the batch they arrived in).
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("new_status", T.StringType()),
    T.StructField("status_ts", T.TimestampNTZType()),
    T.StructField("source", T.StringType()),
])

# Current status, one row per order.
STATUS_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("previous_status", T.StringType()),
    T.StructField("current_status", T.StringType()),
    T.StructField("last_update_ts", T.TimestampNTZType()),
])

STATUS_COLUMNS = [f.name for f in STATUS_SCHEMA.fields]

# Stored per-order state: the current-status row and the latest event side by side,
# so one shuffle of one table serves both the merge and the state update.
STATE_SCHEMA = T.StructType(STATUS_SCHEMA.fields + [
    T.StructField("le_event_id", T.StringType()),
    T.StructField("le_customer_id", T.LongType()),
    T.StructField("le_new_status", T.StringType()),
    T.StructField("le_status_ts", T.TimestampNTZType()),
])
