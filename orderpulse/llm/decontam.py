"""Benchmark decontamination with a distributed positional inverted index.

The index is partitioned by documents: each stored row is a block of about ``BLOCK_WORDS`` words
of consecutive rows of the input and holds, for every term of the block, the sorted list of its
word positions. A search takes the test phrases in chunks of bounded size, and in every block
starts from the phrase's rarest term there, intersects its offset-adjusted list with those of the
next rarest terms, and stops as soon as a list is missing or the intersection is empty. Nothing is
shuffled but the hits; a document, however long, lies in one block.

Defined cases: null and empty texts have no words and no hits, as have null or empty test items;
repeated rows and ids are searched and returned row by row; items of fewer words than a window
are one window; other columns are ignored; an empty table gives no rows, an empty test set no hits.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import alnum_words, free_names, row_hash, shipped, stored

WINDOW = 10
BLOCK_WORDS = 1 << 20
CHUNK_WINDOWS = 200_000      # test windows held by a task at once; more are searched in further passes
INDEX_SCHEMA = ("block bigint, ids array<bigint>, hashes array<bigint>, starts array<bigint>, terms array<binary>, "
                "cuts array<int>, postings binary")
HIT_SCHEMA = "doc_id bigint, h bigint, block bigint, row bigint, n_words bigint, spans array<bigint>, items array<bigint>"


def positional_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     block_words: int = BLOCK_WORDS) -> DataFrame:
    """One stored row per block: ids and hashes of its rows, ``starts`` of their words in the block (one
    more at the end), its terms, and their position lists, one after another, cut at ``cuts``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids, hashes, starts, number, codes = [], [], [0], {}, []
        made, task = 0, TaskContext.get().partitionId()

        def block() -> pa.RecordBatch:
            flat = np.concatenate(codes) if codes else np.zeros(0, np.int32)
            order = np.argsort(flat, kind="stable").astype("<u4")
            cuts = np.cumsum(np.bincount(flat, minlength=len(number)))
            return pa.RecordBatch.from_arrays(
                [pa.array([task << 32 | made], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([hashes], pa.list_(pa.int64())),
                 pa.array([starts], pa.list_(pa.int64())), pa.array([list(number)], pa.list_(pa.binary())),
                 pa.array([np.r_[0, cuts]], pa.list_(pa.int32())), pa.array([order.tobytes()], pa.binary())],
                ["block", "ids", "hashes", "starts", "terms", "cuts", "postings"])

        for batch in batches:
            for i in range(batch.num_rows):
                words = alnum_words(batch.column(2)[i].as_py())
                ids.append(batch.column(0)[i].as_py())
                hashes.append(batch.column(1)[i].as_py())
                for w in set(words):
                    if w not in number:
                        number[w] = len(number)
                codes.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
                starts.append(starts[-1] + len(words))
                if starts[-1] >= block_words:
                    yield block()
                    made += 1
                    ids, hashes, starts, number, codes = [], [], [0], {}, []
        if ids:
            yield block()

    three = shipped(docs).select(F.col(id_col).cast("bigint").alias("id"), row_hash(text_col).alias("h"),
                                 F.col(text_col).alias("text"))
    return stored(three.mapInArrow(run, INDEX_SCHEMA), "positional-index")


class Postings:
    """The position lists of one block."""

    def __init__(self, row: dict):
        self.starts = np.array(row["starts"], np.int64)
        self.block, self.ids, self.hashes = row["block"], row["ids"], row["hashes"]
        self.number = {t: i for i, t in enumerate(row["terms"])}
        self.cuts = np.array(row["cuts"], np.int64)
        self.flat = np.frombuffer(row["postings"], "<u4").astype(np.int64)

    def of(self, number: int) -> np.ndarray:
        return self.flat[self.cuts[number]:self.cuts[number + 1]]

    def document(self, positions: np.ndarray) -> np.ndarray:
        """Rows (within the block) that the positions lie in."""
        return np.searchsorted(self.starts, positions, "right") - 1

    def numbers(self, phrase) -> list[int] | None:
        got = [self.number.get(t) for t in phrase]
        return None if None in got else got

    def exact(self, phrase) -> np.ndarray:
        """Start positions of the phrase, from the rarest term on."""
        got = self.numbers(phrase)
        if got is None:
            return _NONE
        size = self.cuts
        order = sorted(range(len(got)), key=lambda k: size[got[k] + 1] - size[got[k]])
        at = self.of(got[order[0]]) - order[0]
        for k in order[1:]:
            at = _both(at, self.of(got[k]) - k)
            if not len(at):
                return _NONE
        at = at[at >= 0]
        return at[self.document(at) == self.document(at + len(got) - 1)] if len(at) else _NONE

    def near(self, phrase, within: int) -> np.ndarray:
        """Positions of the phrase's rarest term that have every other term of it at most ``within``
        words away in the same document."""
        got = self.numbers(set(phrase))
        if got is None:
            return _NONE
        got.sort(key=lambda k: self.cuts[k + 1] - self.cuts[k])
        at = self.of(got[0])
        doc = self.document(at)
        low = np.maximum(at - within, self.starts[doc])
        high = np.minimum(at + within, self.starts[doc + 1] - 1)
        for k in got[1:]:
            there = self.of(k)
            ok = np.searchsorted(there, low, "left") < np.searchsorted(there, high, "right")
            at, low, high = at[ok], low[ok], high[ok]
            if not len(at):
                break
        return at


_NONE = np.zeros(0, np.int64)


def _both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Values of the sorted list ``a`` that the sorted list ``b`` has too."""
    i = np.searchsorted(b, a)
    i[i == len(b)] = 0
    return a[b[i] == a]


def windows_of(text: str | None, window: int = WINDOW) -> list[tuple]:
    words = alnum_words(text)
    if not words:
        return []
    return [tuple(words[i:i + window]) for i in range(max(1, len(words) - window + 1))]


def _chunks(items: DataFrame, id_col: str, text_col: str, window: int, chunk: int) -> Iterator[dict]:
    """{phrase: item ids}, at most about ``chunk`` windows at a time."""
    held: dict[tuple, set] = defaultdict(set)
    for row in items.select(F.col(id_col).cast("bigint"), F.col(text_col)).toLocalIterator():
        for w in windows_of(row[1], window):
            held[w].add(row[0])
            if len(held) >= chunk:
                yield dict(held)
                held = defaultdict(set)
    if held:
        yield dict(held)


def search(index: DataFrame, items: DataFrame, window: int = WINDOW, item_col: str = "item_id", text_col: str = "text",
           within: int | None = None, chunk: int = CHUNK_WINDOWS) -> DataFrame:
    """One row per indexed document: doc_id, h, n_words, n_hit (its words inside an occurrence of a
    window), items (sorted ids of the items with an occurring window). With ``within``, an occurrence
    is a proximity match instead (see ``Postings.near``), whose hit is the place of the rarest term."""
    sc = index.sparkSession.sparkContext

    def passed(phrases) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    row = {n: batch.column(k)[i].as_py() for k, n in enumerate(
                        ("block", "ids", "hashes", "starts", "terms", "cuts", "postings"))}
                    yield _search_block(Postings(row), phrases.value, within)

        return shipped(index).mapInArrow(run, HIT_SCHEMA)

    parts = [passed(sc.broadcast(phrases)) for phrases in _chunks(items, item_col, text_col, window, chunk)]
    if not parts:
        parts = [passed(sc.broadcast({}))]
    if len(parts) == 1:
        return parts[0].select("doc_id", "h", "n_words", _covered("spans").alias("n_hit"),
                               F.array_sort("items").alias("items"))
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    # a row (its place in the index) has one part for every pass
    grouped = rows.groupBy("doc_id", "h", "block", "row").agg(
        F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.flatten(F.collect_list("items")).alias("items"))
    return grouped.select("doc_id", "h", "n_words", _covered("spans").alias("n_hit"),
                          F.array_sort(F.array_distinct("items")).alias("items"))


def _covered(spans: str) -> F.Column:
    """Words inside the union of spans, given as start << 32 | end (exclusive)."""
    return F.aggregate(
        F.array_sort(spans), F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("to")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x.bitwiseAND(0xFFFFFFFF) - F.greatest(s["to"], F.shiftright(x, 32)))).alias("n"),
            F.greatest(s["to"], x.bitwiseAND(0xFFFFFFFF)).alias("to")), lambda s: s["n"])


def _search_block(postings: Postings, phrases: dict, within: int | None) -> pa.RecordBatch:
    starts = postings.starts
    n = len(starts) - 1
    spans, items = defaultdict(list), defaultdict(set)
    for phrase, owners in phrases.items():
        at = postings.exact(phrase) if within is None else postings.near(phrase, within)
        if not len(at):
            continue
        docs = postings.document(at)
        size = len(phrase) if within is None else 1
        for d, p in zip(docs.tolist(), (at - starts[docs]).tolist()):
            spans[d].append((p, p + size))
            items[d] |= owners
    merged = []
    for d in range(n):
        out: list[list[int]] = []
        for a, b in sorted(spans.get(d, ())):
            if out and a <= out[-1][1]:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b])
        merged.append([a << 32 | b for a, b in out])
    return pa.RecordBatch.from_arrays(
        [pa.array(postings.ids, pa.int64()), pa.array(postings.hashes, pa.int64()),
         pa.array([postings.block] * n, pa.int64()), pa.array(range(n), pa.int64()),
         pa.array(np.diff(starts)), pa.array(merged, pa.list_(pa.int64())),
         pa.array([sorted(i for i in items.get(d, ()) if i is not None) for d in range(n)], pa.list_(pa.int64()))],
        ["doc_id", "h", "block", "row", "n_words", "spans", "items"])


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                  **names) -> DataFrame:
    """``docs`` without the rows that hold a window of a test item."""
    hits = search(positional_index(docs, id_col, text_col), items, window, **names).where("n_hit > 0")
    key, row = free_names(docs, "_key", "_row")
    hits = hits.select(F.col("doc_id").alias(key), F.col("h").alias(row)).distinct()
    marked = docs.withColumns({key: F.col(id_col).cast("bigint"), row: row_hash(text_col)})
    clean = marked.join(hits, marked[key].eqNullSafe(hits[key]) & (marked[row] == hits[row]), "left_anti")
    return clean.drop(key, row)
