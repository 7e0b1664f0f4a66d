"""Embedding near-duplicates by dual traversal of cover trees.

Equal vectors are one class. Classes are dealt to blocks of near vectors (by the nearest of some
centres taken from a bounded sample, large cells cut into several blocks); each block becomes a cover
tree on the unit sphere: nested levels of centres with halving radii, every point within the radius
of its centre. Links at ``cosine >= threshold`` are pairs within ``sqrt(2 - 2 threshold)`` of each
other, so a pair of nodes whose centres are further apart than that plus both covering radii holds
none and is pruned, first for whole blocks (the roots), then level by level for pairs of trees in
a task. What is left at the points is compared in double precision. Every block meets every
block that the root bound leaves, so all pairs are found.

A task holds its own tree and one other at a time and returns, for each point with links, their
number (by class sizes) and one representative of its links' component: never all pairs.

Defined cases: vectors that are null, empty, zero or with null or non-finite components link with nothing;
vectors of different lengths have no cosine, and each length has trees of its own; repeated rows are equal vectors and link with each other; a null
id is never the smallest of a component; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import connected_components, shipped, stored

THRESHOLD = 0.9
BLOCK_ROWS = 2048
MAX_BLOCKS = 4096            # beyond it blocks grow: centres and radii of all blocks are broadcast
LEAST_RADIUS = 1 / 16
SLACK = 1e-9                 # on distances, for rounding
WALK = 8                     # a node pair costs about as much as so many entries of a matrix product
TREE_SCHEMA = "block int, center array<double>, radius double, tree binary"


class CoverTree:
    """Levels of (point, parent, radius): level 0 is the root, the last level is all points."""

    def __init__(self, vectors: np.ndarray, keys: np.ndarray, sizes: np.ndarray):
        self.raw, self.keys, self.sizes = vectors, keys, sizes
        v = vectors.astype(np.float64)
        self.x = v / np.linalg.norm(v, axis=1, keepdims=True)
        self.levels = self._build()

    def _build(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        x, n = self.x, len(self.x)
        mean = x.mean(0)
        root = int(np.argmax(x @ mean))
        owner = np.zeros(n, np.int64)  # node of each point at the level
        centers = np.array([root])
        levels = [(centers, np.zeros(1, np.int64), self._radii(centers, owner))]
        radius = 1.0
        while radius >= LEAST_RADIUS and (levels[-1][2] > 0).any():
            new_owner = np.full(n, -1, np.int64)
            order = np.argsort(owner, kind="stable")
            starts = np.searchsorted(owner[order], np.arange(len(centers) + 1))
            alone = np.flatnonzero(np.diff(starts) == 1)  # a node of one point stays as it is
            points, parents = centers[alone].tolist(), alone.tolist()
            new_owner[order[starts[alone]]] = np.arange(len(alone))
            for node in np.flatnonzero(np.diff(starts) > 1):
                left = order[starts[node]:starts[node + 1]]
                pick = centers[node]  # nesting: a centre is its own child
                least = 1 - radius * radius / 2
                cos = x[left] @ x[left].T if len(left) <= 4096 else None
                place = {int(v): k for k, v in enumerate(left)} if cos is not None else {}
                alive = np.ones(len(left), bool)
                at = 0
                while True:
                    near = alive & ((cos[place[int(pick)]] if cos is not None else x[left] @ x[pick]) >= least)
                    near |= left == pick
                    new_owner[left[near]] = len(points)
                    points.append(pick)
                    parents.append(node)
                    alive &= ~near
                    while at < len(left) and not alive[at]:
                        at += 1
                    if at == len(left):
                        break
                    pick = left[at]
            owner, centers = new_owner, np.array(points)
            levels.append((centers, np.array(parents), self._radii(centers, owner)))
            radius /= 2
        levels.append((np.arange(n), owner, np.zeros(n)))
        return levels

    def _radii(self, centers: np.ndarray, owner: np.ndarray) -> np.ndarray:
        d = np.linalg.norm(self.x - self.x[centers[owner]], axis=1)
        out = np.zeros(len(centers))
        np.maximum.at(out, owner, d)
        return out


def linked_pairs(a: CoverTree, b: CoverTree, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all point pairs of the two trees with cosine at or over the threshold. Node pairs are taken level
    by level; where the pairs left would cost more than one matrix product of all points (nothing much is pruned,
    as for vectors spread all over), that product follows at once."""
    tau = np.sqrt(2 - 2 * threshold) + SLACK
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    depth = max(len(a.levels), len(b.levels))
    for step in range(depth):
        la, lb = min(step, len(a.levels) - 1), min(step, len(b.levels) - 1)
        (pa_, _, ra), (pb_, _, rb) = a.levels[la], b.levels[lb]
        if step:
            own, other = (a.levels[la][1] if la == step else None), (b.levels[lb][1] if lb == step else None)
            up, down = len(a.levels[la - 1][0]) if la == step else 0, len(b.levels[lb - 1][0]) if lb == step else 0
            count_a = np.bincount(own, minlength=up)[i] if own is not None else 1
            count_b = np.bincount(other, minlength=down)[j] if other is not None else 1
            if np.sum(count_a * count_b) * WALK > len(a.x) * len(b.x):
                i, j = _near_points(a.x, b.x, threshold)
                break
            i, j = _expand(i, j, own, other, up, down)
        ok = np.empty(len(i), bool)
        for at in range(0, len(i), 1 << 15):
            p, q = i[at:at + (1 << 15)], j[at:at + (1 << 15)]
            cos = np.einsum("ij,ij->i", a.x[pa_[p]], b.x[pb_[q]])
            ok[at:at + (1 << 15)] = np.sqrt(np.maximum(2 - 2 * cos, 0)) <= ra[p] + rb[q] + tau
        i, j = i[ok], j[ok]
        if not len(i):
            return i, j
    exact = np.empty(len(i), bool)
    for at in range(0, len(i), 1 << 15):
        exact[at:at + (1 << 15)] = np.einsum("ij,ij->i", a.x[i[at:at + (1 << 15)]], b.x[j[at:at + (1 << 15)]]) >= threshold
    return i[exact], j[exact]


def _near_points(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Point pairs that may reach the threshold: products in single precision with a slack that covers their
    rounding; what they let through is measured again in double precision."""
    x, y = x.astype(np.float32), y.astype(np.float32)
    found = []
    for at in range(0, len(x), 1 << 11):
        i, j = np.nonzero(x[at:at + (1 << 11)] @ y.T >= np.float32(threshold - 1e-5))
        found.append((i + at, j))
    return np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found])


def _expand(i, j, parents_a, parents_b, na: int, nb: int):
    """Children pairs of node pairs; a tree without a further level keeps its nodes."""
    for parents, n, first in ((parents_a, na, True), (parents_b, nb, False)):
        if parents is None:
            continue
        order = np.argsort(parents, kind="stable")
        starts = np.searchsorted(parents[order], np.arange(n + 1))
        own = i if first else j
        count = starts[own + 1] - starts[own]
        rep = np.repeat(np.arange(len(own)), count)
        within = np.arange(len(rep)) - np.repeat(np.cumsum(count) - count, count)
        children = order[starts[own[rep]] + within]
        i, j = (children, j[rep]) if first else (i[rep], children)
    return i, j


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index that each of n nodes reaches over the links."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            return root


def _pack(tree: CoverTree) -> bytes:
    """Vectors that single precision holds exactly travel in it."""
    import pickle

    with np.errstate(over="ignore"):
        single = tree.raw.astype(np.float32)
    raw = single if (single == tree.raw).all() else tree.raw
    levels = [(p.astype(np.int32), o.astype(np.int32), r) for p, o, r in tree.levels]
    return pickle.dumps((raw, tree.keys, tree.sizes, levels), protocol=5)


def _unpack(data: bytes) -> CoverTree:
    import pickle

    tree = CoverTree.__new__(CoverTree)
    tree.raw, tree.keys, tree.sizes, tree.levels = pickle.loads(data)
    v = tree.raw.astype(np.float64)
    tree.x = v / np.linalg.norm(v, axis=1, keepdims=True)
    return tree


def vector_classes(vectors: DataFrame, vec_col: str = "embedding") -> DataFrame:
    """(cls, v, size): distinct usable vectors and how often each occurs."""
    v = F.col(vec_col)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    usable = vectors.where(v.isNotNull() & F.coalesce(finite & F.exists(v, lambda c: c != 0), F.lit(False)))
    return usable.groupBy(v.cast("array<double>").alias("v")).agg(F.count("*").alias("size")).select(
        F.xxhash64("v").alias("cls"), "v", "size")


def cover_trees(classes: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One stored row per block: its tree, and the root's centre and covering radius."""
    n = classes.count()
    rows = max(block_rows, -(-n // MAX_BLOCKS))
    k = max(1, n // rows)
    # centres by length: only vectors of one length meet; a length without a centre is one cell
    lengths = [r.dim for r in classes.select(F.size("v").alias("dim")).distinct().orderBy("dim").collect()]
    seeds = classes.orderBy("cls").limit(k).select("v").collect()  # at most MAX_BLOCKS
    centers, first, total = {}, {}, 0
    for dim in lengths:
        points = np.array([r.v for r in seeds if len(r.v) == dim], float).reshape(-1, dim)
        centers[dim] = points / np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-300)
        first[dim], total = total, total + max(1, len(points))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1).to_pylist()
            size = np.array([len(v) for v in vectors], int)
            cell = np.zeros(len(vectors), int)
            for dim in np.unique(size).tolist():
                at = np.flatnonzero(size == dim)
                x = np.array([vectors[i] for i in at], float)
                cell[at] = first[dim] + (np.argmax(x @ centers[dim].T, axis=1) if len(centers[dim]) else 0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32())], ["cls", "v", "size", "cell"])

    same = shipped(classes).select("cls", "v", "size")
    celled = stored(same.mapInArrow(assign, "cls bigint, v array<double>, size bigint, cell int"), "vector-cells")
    counts = celled.groupBy("cell").count().orderBy("cell").collect()  # one row a cell
    cuts, total = {}, 0
    for r in counts:
        parts = -(-r["count"] // rows)
        cuts[r.cell] = (total, parts)
        total += parts
    if not cuts:
        return classes.sparkSession.createDataFrame([], TREE_SCHEMA)
    table = F.create_map(*[F.lit(x) for c, (f, p) in cuts.items() for x in (c, f * (1 << 16) + p)])
    code = table[F.col("cell")]
    block = (F.floor(code / (1 << 16)) + F.pmod(F.xxhash64("cls"), code % (1 << 16))).cast("int")

    def build(pdf):
        import pandas as pd

        pdf = pdf.sort_values("cls")
        tree = CoverTree(np.array(pdf["v"].tolist(), float), pdf["cls"].to_numpy(), pdf["size"].to_numpy())
        root = tree.levels[0]
        return pd.DataFrame([{"block": int(pdf["block"].iloc[0]), "center": tree.x[root[0][0]].tolist(),
                              "radius": float(root[2][0]), "tree": _pack(tree)}])

    return stored(celled.withColumn("block", block).groupBy("block").applyInPandas(build, TREE_SCHEMA), "cover-trees")


def links(trees: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(cls, other, n): for every class with links and every block that it has some in, the number of
    linked vectors there, and one class of their component."""
    tau = float(np.sqrt(2 - 2 * threshold)) + SLACK
    # at most MAX_BLOCKS centres, each of one vector's size
    roots = trees.select("block", "center", "radius")
    other = roots.select(F.col("block").alias("b2"), F.col("center").alias("c2"), F.col("radius").alias("r2"))
    apart = F.sqrt(F.aggregate(F.zip_with("center", "c2", lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, d: s + d))
    pairs = (roots.join(F.broadcast(other), (F.col("block") <= F.col("b2")) & (F.size("center") == F.size("c2")))
             .where(apart <= F.col("radius") + F.col("r2") + tau).select("block", "b2"))
    # a pair is worked on where either of its blocks lives, in turn
    turn = (F.col("block") + F.col("b2")) % 2 == 0
    asked = pairs.select(F.when(turn, F.col("block")).otherwise(F.col("b2")).alias("home"),
                         F.when(turn, F.col("b2")).otherwise(F.col("block")).alias("guest"))
    own = trees.select(F.col("block").alias("home"), F.lit(-1).alias("guest"), "tree")
    sent = asked.join(trees.select(F.col("block").alias("guest"), "tree"), "guest").select("home", "guest", "tree")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home = None
        for batch in batches:
            for k in range(batch.num_rows):
                block, guest = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
                tree = _unpack(batch.column(2)[k].as_py())
                if guest == -1:
                    home = tree
                    continue
                i, j = linked_pairs(home, tree, threshold)
                if guest == block:
                    i, j = i[i != j], j[i != j]
                    keys, sizes = home.keys, home.sizes
                else:
                    keys, sizes = np.r_[home.keys, tree.keys], np.r_[home.sizes, tree.sizes]
                    i, j = np.r_[i, j + len(home.keys)], np.r_[j + len(home.keys), i]
                if not len(i):
                    continue
                n = np.bincount(i, weights=sizes[j], minlength=len(keys)).astype(np.int64)
                root = _roots(len(keys), i, j)
                has = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(keys[has]), pa.array(keys[root[has]]), pa.array(n[has])],
                                                 ["cls", "other", "n"])

    dealt = own.unionByName(sent).repartition("home").sortWithinPartitions("home", "guest")
    return shipped(dealt).mapInArrow(run, "cls bigint, other bigint, n bigint")


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vec_col: str = "embedding",
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id) of every row."""
    classes = stored(vector_classes(vectors, vec_col), "vector-classes")
    found = stored(links(cover_trees(classes, block_rows), threshold), "vector-links")
    roots = connected_components(found.select("cls", "other"), "cls", "other")
    counts = found.groupBy("cls").agg(F.sum("n").alias("n"))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    keyed = rows.select("vec_id", F.xxhash64("v").alias("cls"))
    # few classes beside rows; a class that a third of all rows have is summed before the join
    smallest = keyed.groupBy("cls").agg(F.min("vec_id").alias("first"))
    named = (classes.select("cls", "size").join(counts, "cls", "left").join(roots, F.col("cls") == F.col("node"), "left")
             .join(smallest, "cls").select("cls", "size", "n", F.coalesce("root", "cls").alias("root"), "first"))
    best = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(best, "root").select("cls", (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id")
    out = keyed.join(named, "cls", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
