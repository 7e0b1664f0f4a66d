"""orderpulse — order-status event analytics on Spark.

Events land in a raw table, are reduced to the latest event per order and
conditionally upserted into a current-status table; validation and
monitoring queries reconcile the two. Everything is a DataFrame plan.
"""

__version__ = "0.1.0"
