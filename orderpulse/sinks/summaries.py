"""One summary per landed batch, so that metrics over all raw events need no rescan.

Layout: ``ids/batch_id=<n>`` holds the batch's distinct order ids as bitmaps, ``stats/batch_id=<n>`` one row
with its event count, newest time and a sketch of how late its events were. A batch that is landed again
replaces its summary, so it never counts twice. ``fold`` unites the summaries up to a batch into one
(``upto=<n>``): the sum, the union of the bitmaps and the merged sketch lose nothing. Readers take the newest
fold that is whole and the batches after it.

A bitmap covers 32,768 neighbouring ids (``bitmap_bucket_number``; negative ids have buckets below 0), so a
distinct count is exact: bitmaps of a bucket are united and their bits counted, partially before the
exchange. Ids that lie far apart have a bitmap each, whose zeros Parquet compresses away.

Lateness: seconds of an event's time behind the newest time of the batches before its own (negative: ahead;
none in the first batch, and where a time is null).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.operators.joins import combine_one_row
from orderpulse.session import delete_path, list_names

IDS_SCHEMA = "bucket bigint, bitmap binary"
STATS_SCHEMA = "events bigint, latest_event timestamp_ntz, lateness binary"
#: Size of the quantile sketches, and a bound on the error of a rank that they meet in all but about one of a
#: hundred thousand cases (twice the normalised error of a sketch of this size).
SKETCH_K = 400
RANK_ERROR = 0.02


def id_bitmaps(ids: DataFrame, col: str = "order_id") -> DataFrame:
    """(bucket, bitmap) of the distinct non-null ids; partial bitmaps are united before the exchange."""
    rows = ids.where(F.col(col).isNotNull()).select(F.bitmap_bucket_number(col).alias("bucket"), F.bitmap_bit_position(col).alias("bit"))
    return rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def united(bitmaps: DataFrame) -> DataFrame:
    return bitmaps.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


class BatchSummaries:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _whole(self, kind: str) -> list[int]:
        """Numbers of the summaries of a kind (``batch_id`` or ``upto``) that are whole: statistics come last."""
        names = [n for n in list_names(self.spark, f"{self.root}/stats") if n.startswith(f"{kind}=")]
        return sorted(int(n.split("=")[1]) for n in names if "_SUCCESS" in list_names(self.spark, f"{self.root}/stats/{n}"))

    def parts(self, before: int | None = None) -> list[str]:
        """Names of the summaries that together hold every batch (``before`` a batch) once."""
        folds = [n for n in self._whole("upto") if before is None or n < before]
        base = folds[-1] if folds else None
        singles = [n for n in self._whole("batch_id") if (base is None or n > base) and (before is None or n < before)]
        return [*(f"upto={n}" for n in folds[-1:]), *(f"batch_id={n}" for n in singles)]

    def _read(self, kind: str, schema: str, parts: list[str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/{kind}/{p}" for p in parts))

    def ids(self, parts: list[str] | None = None) -> DataFrame:
        return self._read("ids", IDS_SCHEMA, self.parts() if parts is None else parts)

    def stats(self, parts: list[str] | None = None) -> DataFrame:
        return self._read("stats", STATS_SCHEMA, self.parts() if parts is None else parts)

    def add(self, events: DataFrame, batch_id: int) -> None:
        """Summarise one landed batch; its rows alone are read, and the statistics of the batches before."""
        newest = self.stats(self.parts(before=batch_id)).agg(F.max("latest_event").cast("string")).first()[0]
        id_bitmaps(events).write.mode("overwrite").parquet(f"{self.root}/ids/batch_id={int(batch_id)}")
        late = F.timestamp_diff("SECOND", F.col("status_ts"), F.lit(newest).cast("timestamp_ntz"))
        stats = events.agg(F.count(F.lit(1)).alias("events"), F.max("status_ts").alias("latest_event"),
                           F.kll_sketch_agg_bigint(late, F.lit(SKETCH_K)).alias("lateness"))
        stats.write.mode("overwrite").parquet(f"{self.root}/stats/batch_id={int(batch_id)}")

    def fold(self, up_to: int) -> None:
        """One summary in place of those up to ``up_to``, for batches that will not come again."""
        old = self.parts(before=up_to + 1)
        if len(old) < 2:
            return
        into = f"upto={int(up_to)}"
        united(self.ids(old)).write.mode("overwrite").parquet(f"{self.root}/ids/{into}")
        self.stats(old).agg(F.sum("events").alias("events"), F.max("latest_event").alias("latest_event"),
                            F.kll_merge_agg_bigint("lateness").alias("lateness")
                            ).write.mode("overwrite").parquet(f"{self.root}/stats/{into}")
        for part in old:  # readers no longer take these
            for kind in ("stats", "ids"):
                delete_path(self.spark, f"{self.root}/{kind}/{part}")

    def distinct_orders(self) -> DataFrame:
        """One row, unique_orders: exact over all batches."""
        return united(self.ids()).agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).cast("bigint").alias("unique_orders"))

    def event_stats(self) -> DataFrame:
        """total_events, unique_orders, latest_event -- as ``monitor.event_stats`` over all raw events."""
        rows = self.stats().agg(F.coalesce(F.sum("events"), F.lit(0)).alias("total_events"), F.max("latest_event").alias("latest_event"))
        return combine_one_row(rows, self.distinct_orders()).select("total_events", "unique_orders", "latest_event")

    def lateness_quantiles(self, ranks) -> DataFrame:
        """(rank, lateness_seconds) over all batches, from the merged sketches."""
        merged = self.stats().agg(F.kll_merge_agg_bigint("lateness").alias("s"))
        rows = [F.struct(F.lit(float(r)).alias("rank"), F.kll_sketch_get_quantile_bigint("s", F.lit(float(r))).alias("lateness_seconds"))
                for r in ranks]
        return merged.select(F.inline(F.array(*rows)))
