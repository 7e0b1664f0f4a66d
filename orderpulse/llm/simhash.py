"""SimHash near-duplicates by anchor-point covering.

Anchors are the codewords of a Hamming code of length ``n = 2^r - 1`` over the first ``n`` bits of
the 64-bit fingerprint, a perfect covering code of radius 1. Every distinct fingerprint has one home
anchor within the radius and is replicated to every anchor within radius plus threshold; two
fingerprints that differ in at most ``threshold`` bits therefore meet at the home anchor of either.
Members of an anchor are compared there on all 64 bits, and the links found leave it as a forest, never
as all pairs. ``r`` follows from the number of distinct fingerprints (see ``code_bits``): ``r = 5`` has 67
million anchors and 156 copies at threshold 2, ``r = 6`` more anchors than there are documents, and 652 copies.
The links join the same fingerprints under either.

Defined cases: equal fingerprints (copies) are one node; texts without words (null and empty
ones too) have fingerprint zero and link like any other; a null ``doc_id`` is never the smallest
id of a component; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import connected_components, free_names, row_hash, shipped, space_words, stored

SHINGLE, THRESHOLD = 3, 2
MEMBERS = 256                # of an anchor on average, at most, before the longer code is taken
COPIES_PER_TASK = 1 << 20
_BITS = 1 << np.arange(64, dtype=np.uint64)


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit set where over half of the XXH64 (seed 42) hashes of the word shingles have it."""
    import xxhash

    words = space_words(text)
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), 42)
    total = len(words) - shingle + 1
    counts = np.zeros(64, np.int64)
    for at in range(0, total, 1 << 14):
        part = words[at:min(at + (1 << 14), total) + shingle - 1]
        grams = zip(*(part[i:len(part) - shingle + 1 + i] for i in range(shingle)))
        h = np.array([digest(b" ".join(g), 42) for g in grams], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(_BITS[counts * 2 > total].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, fp): SimHash as a signed long, and the hash that tells rows of one id apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([simhash(t.as_py(), shingle) for t in batch.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp)], ["doc_id", "h", "fp"])

    two = shipped(docs).select(F.col(id_col).cast("bigint").alias("doc_id"), row_hash(text_col).alias("h"),
                               F.col(text_col).alias("text"))
    return two.mapInArrow(run, "doc_id bigint, h bigint, fp bigint")


class HammingAnchors:
    """Home and neighbouring codewords of the Hamming code of length 2^r - 1 (positions 1..n; a
    word's syndrome is the XOR of the positions of its set bits, 0 for a codeword)."""

    def __init__(self, r: int = 5, threshold: int = THRESHOLD):
        self.n = (1 << r) - 1
        self.mask = np.uint64((1 << self.n) - 1)
        # flips of at most radius + threshold bits, listed by the syndrome that they cancel
        by: dict[int, list[int]] = {s: [] for s in range(self.n + 1)}
        for size in range(threshold + 2):
            for chosen in combinations(range(1, self.n + 1), size):
                s = flip = 0
                for p in chosen:
                    s, flip = s ^ p, flip | 1 << (p - 1)
                by[s].append(flip)
        self.flips = {s: np.array(v, np.uint64) for s, v in by.items()}

    def syndrome(self, x: np.ndarray) -> np.ndarray:
        bits = np.unpackbits(x.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :self.n]
        return np.bitwise_xor.reduce(bits * np.arange(1, self.n + 1, dtype=np.uint8), axis=1)

    def home(self, x: np.ndarray) -> np.ndarray:
        s = self.syndrome(x).astype(np.uint64)
        return (x & self.mask) ^ np.where(s > 0, np.uint64(1) << (np.maximum(s, np.uint64(1)) - np.uint64(1)), np.uint64(0))

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the fingerprint, anchor) for every anchor within radius plus threshold."""
        s = self.syndrome(x)
        who, where = [], []
        for value in np.unique(s):
            rows = np.flatnonzero(s == value)
            flips = self.flips[int(value)]
            who.append(np.repeat(rows, len(flips)))
            where.append(((x[rows] & self.mask)[:, None] ^ flips[None, :]).ravel())
        return np.concatenate(who), np.concatenate(where)


def copies_of(threshold: int, r: int) -> int:
    """Anchors that a fingerprint is replicated to: codewords within 1 + threshold of it, on average."""
    n = (1 << r) - 1
    return -(-sum(comb(n, k) for k in range(threshold + 2)) // (n + 1))


def code_bits(distinct: int, threshold: int = THRESHOLD) -> int:
    """5, or 6 where the anchors of the shorter code would have over ``MEMBERS`` members on average."""
    return 5 if distinct * copies_of(threshold, 5) <= MEMBERS << 26 else 6


def anchor_links(distinct: DataFrame, threshold: int = THRESHOLD, r: int | None = None) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp`` that join the same fingerprints as all pairs
    within ``threshold`` bits do."""
    n = distinct.agg(F.approx_count_distinct("fp")).first()[0]
    r = r or code_bits(n, threshold)
    tasks = max(1, -(-n * copies_of(threshold, r) // COPIES_PER_TASK))

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = HammingAnchors(r, threshold)
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(x), 2048):
                part = x[at:at + 2048]
                who, anchor = code.visits(part)
                at_home = anchor == code.home(part)[who]
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(part[who].view(np.int64)),
                                                  pa.array(at_home)], ["anchor", "fp", "home"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # rows of the anchor that the last batch may have cut

        def arrays(batch):
            return (batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64),
                    batch.column(2).to_numpy(zero_copy_only=False))

        def out(rows: tuple) -> Iterator[pa.RecordBatch]:
            for a, b in _forest_in_anchors(*rows, threshold):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            now = arrays(batch)
            if held and now[0][-1] == held[-1][0][0]:
                held.append(now)
                continue
            rows = tuple(np.concatenate(c) for c in zip(*held, now)) if held else now
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            yield from out(tuple(c[:cut] for c in rows))
            held = [tuple(c[cut:] for c in rows)]
        if held:
            yield from out(tuple(np.concatenate(c) for c in zip(*held)))

    copies = shipped(distinct).select("fp").repartition(tasks, "fp").mapInArrow(replicate, "anchor bigint, fp bigint, home boolean")
    dealt = copies.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(compare, "a bigint, b bigint")


def _forest_in_anchors(anchor: np.ndarray, fp: np.ndarray, home: np.ndarray, threshold: int):
    """Arrays of links (a, b) in each run of equal anchors: a home member reaches unlinked members
    within the threshold one after another, so a run of m members gives fewer than m links."""
    if not len(anchor):
        return
    starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    sizes = np.diff(np.r_[starts, len(anchor)])
    homes = np.add.reduceat(home.astype(np.int64), starts)
    todo = np.flatnonzero((sizes > 1) & (homes > 0))
    small = todo[sizes[todo] <= 64]
    # small runs together: members k apart in sorted order, one k after another
    inside = np.zeros(len(anchor), bool)
    if len(small):
        inside[np.repeat(starts[small], sizes[small]) + _ranges(sizes[small])] = True
        left = np.flatnonzero(inside)
        k = 1
        while len(left):
            left = left[left + k < len(anchor)]
            left = left[anchor[left] == anchor[left + k]]
            other = left + k
            hit = (home[left] | home[other]) & (np.bitwise_count(fp[left] ^ fp[other]) <= threshold)
            if hit.any():
                yield fp[left[hit]], fp[other[hit]]
            k += 1
    for g in todo[sizes[todo] > 64]:
        part = slice(starts[g], starts[g] + sizes[g])
        x, at_home = fp[part], home[part]
        alone = np.ones(len(x), bool)
        a, b = [], []
        for seed in np.flatnonzero(at_home):
            stack = [seed] if alone[seed] else []
            alone[seed] = False
            while stack:
                i = stack.pop()
                if not at_home[i]:
                    continue
                near = np.flatnonzero(alone)
                near = near[np.bitwise_count(x[near] ^ x[i]) <= threshold]
                alone[near] = False
                a.append(np.full(len(near), x[i]))
                b.append(x[near])
                stack.extend(near.tolist())
            # a visitor linked to two homes joins them: each home must also see linked visitors
        linked = np.flatnonzero(~alone)
        yield from _through_visitors(x, at_home, linked, a, b, threshold)


def _ranges(sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)


def _through_visitors(x, at_home, linked, a, b, threshold):
    """The links found, and for every visitor one link to each tree of homes that it touches."""
    if not a:
        return
    a, b = np.concatenate(a), np.concatenate(b)
    tree = {int(v): int(v) for v in x[at_home]}

    def root(v: int) -> int:
        while tree.get(v, v) != v:
            v = tree[v]
        return v

    for p, q in zip(a.tolist(), b.tolist()):
        tree[q] = root(p)
    extra_a, extra_b = [], []
    homes = np.flatnonzero(at_home)
    for i in linked[~at_home[linked]]:
        near = homes[np.bitwise_count(x[homes] ^ x[i]) <= threshold]
        seen = {root(int(x[i]))}
        for j in near:
            top = root(int(x[j]))
            if top not in seen:
                seen.add(top)
                extra_a.append(x[j])
                extra_b.append(x[i])
    yield np.concatenate([a, np.array(extra_a, np.uint64)]), np.concatenate([b, np.array(extra_b, np.uint64)])


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD, r: int | None = None,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, fp, component_id, rep_id, rep_h): the component of every row; its smallest id, and the
    (id, hash) of the one row that stands for it."""
    rows = stored(fingerprints(docs, shingle, id_col, text_col), "simhash")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")
    classes = rows.groupBy("fp").agg(F.min(first).alias("first"))
    links = stored(anchor_links(classes, threshold, r), "simhash-links")
    roots = connected_components(links, "a", "b")
    classes = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first")
    best = classes.groupBy("root").agg(F.min("first").alias("rep"))
    named = classes.join(best, "root").select("fp", F.col("rep.doc_id").alias("component_id"),
                                              F.col("rep.h").alias("rep_h"))
    return rows.join(named, "fp").select("doc_id", "h", "fp", "component_id", "rep_h")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose component another row stands for; one row stays of each."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    key, row = free_names(docs, "_key", "_row")
    reps = near_duplicates(docs, **options).select(F.col("component_id").alias(key), F.col("rep_h").alias(row)).distinct()
    marked = docs.withColumns({key: F.col(id_col).cast("bigint"), row: row_hash(text_col)})
    kept = marked.join(reps, marked[key].eqNullSafe(reps[key]) & (marked[row] == reps[row]), "left_semi")
    return kept.dropDuplicates([key, row]).drop(key, row)
