"""Event ids of all landed batches, for an exact dedupe over the whole history.

Layout: a part is ``batch_id=<n>`` (one batch) or ``upto=<n>`` (all up to one, see ``fold``), and has

    ids/<part>       its distinct event ids
    filter/<part>    a Bloom filter of them: bitmaps of 32,768 bits (bucket, bitmap), ``HASHES`` bits an id
    range/<part>     one row: number of bitmaps, smallest and greatest id

A new batch's ids are tried against the filters of the parts whose range they are in: joins of a few
numbers an id. Only ids with all their bits in a part's filter are then looked up in that part's ids, and
parts without such an id are not read. A filter has no false negatives, so the dedupe is exact
whatever the age of a redelivery; about one new id in a hundred a part is looked up in vain.

A batch is held against the batches before it, so one that is landed again has the same result. Range rows
come last: a part counts when it is whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.session import delete_path, list_names

BITMAP_BITS = 32_768
BITS_PER_ID, HASHES = 10, 4
IDS_SCHEMA = "event_id string"
FILTER_SCHEMA = "bucket bigint, bitmap binary"
RANGE_SCHEMA = "bitmaps bigint, least string, most string"


def bloom_places(ids: DataFrame, bitmaps, col: str = "event_id") -> DataFrame:
    """(event_id, bucket, bit): where each id's bits lie in a filter of so many bitmaps."""
    places = F.array(*[F.pmod(F.xxhash64(F.lit(i), F.col(col)), F.lit(bitmaps) * F.lit(BITMAP_BITS)) for i in range(HASHES)])
    each = ids.select(F.col(col).alias("event_id"), F.explode(places).alias("_p"))
    return each.select("event_id", (F.shiftright("_p", 15)).alias("bucket"), F.col("_p").bitwiseAND(BITMAP_BITS - 1).alias("bit"))


def has_bit(bitmap: str, bit: str):
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("bigint")
    return F.call_function("shiftright", byte, F.col(bit).bitwiseAND(7).cast("int")).bitwiseAND(1) == 1


class SeenIds:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _whole(self, kind: str) -> list[int]:
        names = [n for n in list_names(self.spark, f"{self.root}/range") if n.startswith(f"{kind}=")]
        return sorted(int(n.split("=")[1]) for n in names if "_SUCCESS" in list_names(self.spark, f"{self.root}/range/{n}"))

    def parts(self, before: int | None = None) -> list[str]:
        """Parts that together hold every batch (before one) once."""
        folds = [n for n in self._whole("upto") if before is None or n < before]
        singles = [n for n in self._whole("batch_id") if (not folds or n > folds[-1]) and (before is None or n < before)]
        return [*(f"upto={n}" for n in folds[-1:]), *(f"batch_id={n}" for n in singles)]

    def _read(self, kind: str, part: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{kind}/{part}")

    def _write(self, ids: DataFrame, part: str) -> None:
        ids.write.mode("overwrite").parquet(f"{self.root}/ids/{part}")
        ids = self._read("ids", part, IDS_SCHEMA)
        told = ids.agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("least"), F.max("event_id").alias("most")).first()
        bitmaps = max(1, -(-told["n"] * BITS_PER_ID // BITMAP_BITS))
        (bloom_places(ids, bitmaps).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
         .write.mode("overwrite").parquet(f"{self.root}/filter/{part}"))
        self.spark.createDataFrame([(bitmaps, told["least"], told["most"])], RANGE_SCHEMA).coalesce(1).write.mode(
            "overwrite").parquet(f"{self.root}/range/{part}")

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Remember the ids of a landed batch; replaces them if it was remembered before."""
        self._write(rows.select("event_id").where("event_id is not null").distinct(), f"batch_id={int(batch_id)}")

    def fold(self, up_to: int) -> None:
        """One part in place of those up to a batch, for batches that will not come again."""
        old = self.parts(before=up_to + 1)
        if len(old) < 2:
            return
        self._write(reduce(DataFrame.unionByName, [self._read("ids", p, IDS_SCHEMA) for p in old]).distinct(), f"upto={int(up_to)}")
        for p in old:
            for kind in ("range", "filter", "ids"):
                delete_path(self.spark, f"{self.root}/{kind}/{p}")

    def candidates(self, ids: DataFrame, part: str) -> DataFrame | None:
        """Ids that the part's filter has; None where their range leaves the part out."""
        mine = ids.agg(F.min("event_id").alias("a"), F.max("event_id").alias("b")).first()
        r = self._read("range", part, RANGE_SCHEMA).first()
        if mine["a"] is None or r["least"] is None or mine["a"] > r["most"] or mine["b"] < r["least"]:
            return None
        inside = ids.where(F.col("event_id").between(r["least"], r["most"]))
        found = bloom_places(inside, r["bitmaps"]).join(self._read("filter", part, FILTER_SCHEMA), "bucket").where(has_bit("bitmap", "bit"))
        return found.groupBy("event_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == HASHES).select("event_id")

    def unseen(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """One row of every id of the batch that no batch before it had; rows without an id pass."""
        named = rows.where("event_id is not null").dropDuplicates(["event_id"])
        ids = named.select("event_id").persist()
        try:
            known = []
            for part in self.parts(before=batch_id):
                maybe = self.candidates(ids, part)
                if maybe is not None and maybe.limit(1).count():
                    known.append(maybe.join(self._read("ids", part, IDS_SCHEMA), "event_id"))
        finally:
            ids.unpersist()
        if known:
            named = named.join(reduce(DataFrame.unionByName, known), "event_id", "left_anti").select(*rows.columns)
        return named.unionByName(rows.where("event_id is null"))
