"""The landing log: who lands into a raw folder, and what every landed micro-batch held.

Layout beside the raw folder::

    _landing/owner.json                     id of the one streaming query that lands here
    _landing/block=<B>/batch-<N>.json       batch_id, good, bad, max_status_ts; B = N // 1000

The owner is written before the first data, a record after the data of its batch, so a batch on
record is whole. A query with another id (its checkpoint was lost or replaced) would number its
batches from 0 again and overwrite others: it is refused, and so is any landing query where raw data
lies that no owner is known for. Readers find what is new from the log: the newest blocks are listed, not the
raw or quarantine folders, which grow with the stream's age.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession

from orderpulse.session import delete_path, list_names, read_small_file, write_small_file

PER_BLOCK = 1000


@dataclass(frozen=True)
class Landed:
    batch_id: int
    good: int
    bad: int
    max_status_ts: str | None = None


class LandingLog:
    def __init__(self, spark: SparkSession, root: str, raw: str, quarantine: str):
        self.spark, self.root, self.data = spark, f"{root.rstrip('/')}/_landing", (raw, quarantine)

    def owner(self) -> str | None:
        text = read_small_file(self.spark, f"{self.root}/owner.json")
        return json.loads(text)["id"] if text else None

    def check(self, query_id: str | None) -> None:
        """Refuse a landing query that does not own the folder (``query_id`` None: a new checkpoint)."""
        owner = self.owner()
        if owner is not None and owner != query_id:
            raise ValueError(f"{self.root} belongs to landing query {owner}, not to {query_id}; one writer per target, "
                             "and a lost checkpoint needs a new folder")
        if owner is None and any(self._has_batches(path) for path in self.data):
            raise ValueError(f"{self.data[0]} holds batches that no landing query is on record for; land into a new folder")

    def _has_batches(self, path: str) -> bool:
        return any(n.startswith("batch_id=") and int(n.split("=")[1]) >= 0 for n in list_names(self.spark, path))

    def claim(self, query_id: str) -> None:
        """Called before a batch is written: the first query that lands is the owner from then on."""
        owner = self.owner()
        if owner == query_id:
            return
        self.check(query_id)
        write_small_file(self.spark, f"{self.root}/owner.json", json.dumps({"id": query_id}) + "\n")
        if self.owner() != query_id:
            raise ValueError(f"another landing query has claimed {self.root}")

    def _file(self, batch_id: int) -> str:
        return f"{self.root}/block={batch_id // PER_BLOCK:010d}/batch-{batch_id:020d}.json"

    def record(self, landed: Landed) -> None:
        """Replaces the record of a batch that is landed again."""
        path = self._file(landed.batch_id)
        if read_small_file(self.spark, path) is not None:
            delete_path(self.spark, path)
        write_small_file(self.spark, path, json.dumps(landed.__dict__) + "\n")

    def after(self, batch_id: int, up_to: int | None = None) -> list[Landed]:
        """Records of the batches after ``batch_id``, in order."""
        out = []
        for block in sorted(n for n in list_names(self.spark, self.root) if n.startswith("block=")):
            first = int(block[len("block="):]) * PER_BLOCK
            if first + PER_BLOCK <= batch_id + 1 or up_to is not None and first > up_to:
                continue
            for name in sorted(n for n in list_names(self.spark, f"{self.root}/{block}") if n.startswith("batch-")):
                n = int(name[len("batch-"):-len(".json")])
                if n > batch_id and (up_to is None or n <= up_to):
                    out.append(Landed(**json.loads(read_small_file(self.spark, f"{self.root}/{block}/{name}"))))
        return out
