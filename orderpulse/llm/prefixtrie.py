r"""Conversation prefix trie by the Euler tour technique.

Conversations are rebuilt: the first h turns of the conversation that opens their group of ``GROUP`` ids, then
their own turns after the first h (h: crc32 of the decimal id, modulo ``LEADS``). Each distinct sequence of
first d rebuilt turns is a node. A node is known by its smallest member and its depth, and numbered in that
order; its children follow each other by number.

The tour enters and leaves every node once: enter to the first child's enter (or to the own exit), exit to the next
sibling's enter (or to the parent's exit). It is list-ranked by contraction: arcs are dealt in ranges of numbers
to chunks of bounded size, every chunk folds the runs of arcs that stay inside it, and what is left is a
shorter weighted list; arcs picked by a coin are then spliced out between chunks, which makes any list
shorter by a quarter, wherever its arcs lie. The list that fits one chunk is ranked there and the ranks are
handed back level by level. Leaves and savings lie on the enter arcs; with prefix sums over the ranks a
subtree's total is the sum up to its exit less the sum before its enter.

A hot conversation is spread over tasks: its rows are numbered from range partitions, and the keys of its prefixes
(sums of two 64-bit hashes of each turn at its place) add up over blocks of turns. A node's members are counted
before the shuffle, and siblings are linked by the row above in range partitions, so neither a node with a
third of all conversations nor one with a third of all children is one task's. The digest of the ids that end at
a node is one sequential hash and streams through one task with constant memory.

Defined cases: a null turn comes first, equal turns are ordered by role and text; null roles and texts are empty;
rows without a conversation id belong to no conversation and are left out; repeated rows are turns each; a
negative id belongs to the group of ``id - id % GROUP`` with the sign of SQL's remainder; other columns are
ignored; an empty table has no conversation, so no node, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderpulse.llm.common import shipped, stored
from orderpulse.operators.sequence import with_previous

GROUP, LEADS = 20, 4
BLOCK_BITS = 14              # 2^14 turns of one conversation, or places of the tour, are added up in one window
CHUNK_ARCS = 1 << 16         # arcs that a task folds at once
_LOW = (1 << 32) - 1


def lead_turns(conv: str = "conv_id") -> Column:
    """h: how many turns a conversation takes from its group's first one."""
    return (F.crc32(F.col(conv).cast("string").cast("binary")) % LEADS).cast("int")


def _running(df: DataFrame, keys: list[str], order: str, sums: dict[str, str]) -> DataFrame:
    """``df`` with running sums over ``order`` (0, 1, 2, ... within the keys): blocks are summed up first, and
    a window adds up one block at a time."""
    df = df.withColumn("_block", F.shiftright(order, BLOCK_BITS))
    totals = df.groupBy(*keys, "_block").agg(*(F.sum(v).alias(f"_{k}") for k, v in sums.items()))
    before = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(*keys, "_block", *(F.coalesce(F.sum(f"_{k}").over(before), F.lit(0)).alias(f"_{k}") for k in sums))
    inside = W.partitionBy(*keys, "_block").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    joined = df.join(totals, [*keys, "_block"])
    return joined.withColumns({k: F.col(f"_{k}") + F.sum(v).over(inside) for k, v in sums.items()}).drop(
        "_block", *(f"_{k}" for k in sums))


def numbered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, t1, t2, words): turns of each conversation numbered from 1, with two hashes of role and text,
    and the words of the text. Rows that are equal throughout are one row with their number, then range
    partitions keep the order (they go by the start of a text, so that their bounds are short), and what
    a conversation has in the partitions before is added to the count inside one."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.where("conv_id is not null").groupBy(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), text("role").alias("role"),
        text("text").alias("text")).agg(F.count("*").alias("times"))
    by = ["conv_id", F.col("turn").asc_nulls_first(), "role"]
    ranged = rows.repartitionByRange(*by, F.substring("text", 1, 32)).sortWithinPartitions(*by, "text").select(
        "conv_id", *(F.xxhash64(F.lit(k), "role", "text").alias(f"t{k}") for k in (1, 2)),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"), F.explode(F.sequence(F.lit(1), F.col("times"))))
    ranged = stored(ranged.drop("col").withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "turns")
    held = ranged.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    # one row for a conversation in a partition
    before = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    held = held.select("conv_id", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return ranged.join(held, ["conv_id", "part"]).select(
        "conv_id", (F.col("before") + F.col("at") - F.col("first") + 1).alias("pos"), "t1", "t2", "words")


def rebuild(turns: DataFrame, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """((conv_id, depth, t1, t2, words), (conv_id, length)) of the rebuilt conversations."""
    rows = stored(numbered_turns(turns), "numbered-turns")
    convs = rows.groupBy("conv_id").agg(F.max("pos").alias("own"))
    base = (F.col("conv_id") - F.col("conv_id") % group).alias("base")
    named = convs.select("conv_id", "own", base, lead_turns().alias("h"))
    firsts = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("of_base"))
    # a conversation opens a group of at most ``group`` ids on either side of 0
    convs = stored(named.join(firsts, "base", "left").select(
        "conv_id", "base", "h", "own", F.least("h", F.coalesce("of_base", F.lit(0))).cast("bigint").alias("taken")), "conversations")
    heads = rows.where((F.col("conv_id") % group == 0) & (F.col("pos") < LEADS)).withColumnRenamed("conv_id", "base")
    lead = convs.where("taken > 0").join(heads, "base").where("pos <= taken").select("conv_id", F.col("pos").alias("depth"), "t1", "t2", "words")
    # how many turns were taken, once for every block of a conversation's turns
    blocks = convs.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.shiftright("own", BLOCK_BITS))))
    own = rows.withColumn("block", F.shiftright("pos", BLOCK_BITS)).where(F.col("pos") > lead_turns())
    own = own.join(blocks.select("conv_id", "block", "h", "taken"), ["conv_id", "block"]).select(
        "conv_id", (F.col("taken") + F.col("pos") - F.col("h")).alias("depth"), "t1", "t2", "words")
    lengths = convs.select("conv_id", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"))
    return lead.unionByName(own), lengths


def trie_nodes(turns: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (node, parent, conv_id, depth, n_convs, words) and the conversations that end at each (node,
    conv_id). ``node`` numbers them by (conv_id, depth)."""
    sized = turns.select("conv_id", "depth", "words", *(F.xxhash64(f"t{k}", "depth").alias(f"h{k}") for k in (1, 2)))
    # four sums of 32 bits each: exact in a long for as many turns as a conversation can have
    halves = {f"{part}{k}": (F.col(f"h{k}").bitwiseAND(_LOW) if part == "lo" else F.shiftrightunsigned(f"h{k}", 32))
              for k in (1, 2) for part in ("lo", "hi")}
    keys = _running(sized.select("conv_id", "depth", "words", *(v.alias(k) for k, v in halves.items())).withColumn("at", F.col("depth") - 1),
                    ["conv_id"], "at", {f"k_{k}": k for k in halves})
    names = list(halves)
    keyed = stored(keys.select("conv_id", "depth", "words", *(f"k_{k}" for k in names),
                               *((F.col(f"k_{k}") - F.col(k)).alias(f"p_{k}") for k in names)), "prefixes")
    here, above = [f"k_{k}" for k in names], [f"p_{k}" for k in names]
    found = keyed.groupBy("depth", *here).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
                                              F.max("words").alias("words"), *(F.min(c).alias(c) for c in above))
    zero = F.lit(0).cast("bigint")
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        zero.alias("depth"), *(zero.alias(c) for c in here), "conv_id", "n_convs", zero.alias("words"),
        *(F.lit(None).cast("bigint").alias(c) for c in above))
    ordered = stored(found.unionByName(root).repartitionByRange("conv_id", "depth").sortWithinPartitions("conv_id", "depth")
                     .withColumn("node", F.monotonically_increasing_id()), "trie-nodes")
    # a hot parent's children are few beside its members; AQE splits what is left of a hot key
    parents = ordered.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), (F.col("depth") + 1).alias("depth"),
                             *(F.col(c).alias(a) for c, a in zip(here, above)))
    nodes = ordered.join(parents, ["depth", *above], "left").select("node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "words")
    last = lengths.join(keyed, (lengths.conv_id == keyed.conv_id) & (lengths.length == keyed.depth)).select(
        lengths.conv_id, "depth", *here)
    bare = lengths.where("length = 0").select("conv_id", zero.alias("depth"), *(zero.alias(c) for c in here))
    ends = last.unionByName(bare).join(ordered.select("node", "depth", *here), ["depth", *here]).select("node", "conv_id")
    return stored(nodes, "trie"), ends


def tour(nodes: DataFrame) -> DataFrame:
    """(arc, succ) of the tour: arc 2 node enters a node, 2 node + 1 leaves it; the root's exit has no
    successor."""
    enter, leave = F.col("node") * 2, F.col("node") * 2 + 1
    siblings = stored(with_previous(nodes.where("parent is not null").select("parent", "node", F.col("node").alias("own")), "parent", ["node"], ["own"])
                      .select("parent", "node", F.when(F.col("has_prev"), F.col("prev_own")).alias("before")), "siblings")
    to_child = siblings.select(F.when(F.col("before").isNull(), F.col("parent") * 2).otherwise(F.col("before") * 2 + 1).alias("arc"),
                               enter.alias("succ"))
    to_parent = siblings.groupBy("parent").agg(F.max("node").alias("node")).select(leave.alias("arc"), (F.col("parent") * 2 + 1).alias("succ"))
    inner = siblings.select(F.col("parent").alias("node")).distinct()
    leaves = nodes.select("node").join(inner, "node", "left_anti").select(enter.alias("arc"), leave.alias("succ"))
    root = nodes.where("parent is null").select(leave.alias("arc"), F.lit(None).cast("bigint").alias("succ"))
    return to_child.unionByName(to_parent).unionByName(leaves).unionByName(root)


def fold_chunk(arc: np.ndarray, succ: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """(head, offset, next, length) of arcs of one chunk (``succ`` -1: none): the first arc of the run inside the
    chunk that an arc is in, the weight before it in the run, and for heads what follows the run and its weight."""
    n = len(arc)
    order = np.argsort(arc)
    at = np.minimum(np.searchsorted(arc[order], succ), n - 1)
    nxt = np.where(arc[order][at] == succ, order[at], -1)       # index of the successor in the chunk
    prev = np.full(n, -1)
    has = np.flatnonzero(nxt >= 0)
    prev[nxt[has]] = has
    # pointer doubling backwards: distance to the head of the run
    jump = np.where(prev >= 0, prev, np.arange(n))
    offset = np.where(prev >= 0, weight[prev], 0)
    while True:
        further = jump[jump]
        if (further == jump).all():
            break
        offset = offset + offset[jump]
        jump = further
    ends = np.flatnonzero(nxt < 0)                              # one last arc for each run
    following, length = np.full(n, -1), np.zeros(n, np.int64)
    following[jump[ends]] = succ[ends]
    length[jump[ends]] = offset[ends] + weight[ends]
    return arc[jump], offset, following, length


def fold(arcs: DataFrame, chunk: int = CHUNK_ARCS, whole: bool = False) -> DataFrame:
    """(arc, head, offset, next, length): runs of arcs folded within chunks of so many arcs in order of number;
    ``whole``: the list has no more than that."""
    names = ["arc", "head", "offset", "next", "length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out(columns):
            done = fold_chunk(*columns)
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (columns[0], *done)], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            size += batch.num_rows
            while size >= chunk:
                columns = [np.concatenate(c) for c in zip(*held)]
                yield out([c[:chunk] for c in columns])
                held, size = [[c[chunk:] for c in columns]], size - chunk
        if size:
            yield out([np.concatenate(c) for c in zip(*held)])

    rows = arcs.select("arc", F.coalesce("succ", F.lit(-1)).cast("bigint").alias("succ"), F.col("weight").cast("bigint").alias("weight"))
    dealt = rows.coalesce(1) if whole else rows.repartitionByRange("arc")
    return shipped(dealt.sortWithinPartitions("arc")).mapInArrow(run, "arc bigint, head bigint, offset bigint, next bigint, length bigint")


def splice(arcs: DataFrame, level: int) -> DataFrame:
    """(arc, head, offset, next, length): arcs whose coin is 1 are folded into the arc before, where its coin is 0."""
    coin = lambda c: F.xxhash64(F.lit(level), c).bitwiseAND(1)
    rows = arcs.select("arc", "succ", "weight", (coin(F.col("arc")) == 1).alias("ready"))
    before = rows.where(~F.col("ready") & (F.col("succ") >= 0) & (coin(F.col("succ")) == 1)).select(
        F.col("arc").alias("b_arc"), F.col("weight").alias("b_weight"), F.col("succ").alias("arc"))
    joined = rows.join(before, "arc", "left")
    gone = joined.where("b_arc is not null").select("arc", F.col("b_arc").alias("head"), F.col("b_weight").alias("offset"), "succ", "weight")
    kept = rows.join(gone.select("head", F.col("succ").alias("g_succ"), F.col("weight").alias("g_weight")), rows.arc == F.col("head"), "left")
    kept = kept.join(gone.select("arc"), "arc", "left_anti")
    one = F.lit(None).cast("bigint")
    return gone.select("arc", "head", "offset", one.alias("next"), one.alias("length")).unionByName(kept.select(
        "arc", F.col("arc").alias("head"), F.lit(0).cast("bigint").alias("offset"), F.coalesce("g_succ", "succ").alias("next"),
        (F.col("weight") + F.coalesce("g_weight", F.lit(0))).alias("length")))


def rank(arcs: DataFrame, chunk: int = CHUNK_ARCS) -> DataFrame:
    """(arc, rank) of a list (arc, succ), ranks from 0."""
    current = arcs.withColumn("weight", F.lit(1).cast("bigint"))
    levels, n = [], None
    while n is None or n > 1:
        whole = n is not None and n <= chunk
        if whole or not levels or spliced:
            level, spliced = stored(fold(current, chunk, whole), "tour-fold"), False
        else:
            level, spliced = stored(splice(current, len(levels)), "tour-splice"), True
        levels.append(level)
        current = level.where("arc = head").select("arc", F.col("next").alias("succ"), F.col("length").alias("weight"))
        n = current.count()
    ranks = current.select("arc", F.lit(0).cast("bigint").alias("rank"))
    for level in reversed(levels):
        # a head has at most a chunk of arcs
        heads = ranks.select(F.col("arc").alias("head"), F.col("rank").alias("first"))
        ranks = stored(level.select("arc", "head", "offset").join(heads, "head").select(
            "arc", (F.col("first") + F.col("offset")).alias("rank")), "tour-ranks")
    return ranks


def subtree_sums(nodes: DataFrame, ranks: DataFrame) -> DataFrame:
    """(node, n_leaves, saved_tokens): prefix sums over the tour, taken at each node's two arcs."""
    arcs = ranks.select(F.shiftright("arc", 1).alias("node"), "rank")
    placed = stored(nodes.select("node", "words", "n_convs").join(arcs.groupBy("node").agg(
        F.min("rank").alias("enter"), F.max("rank").alias("leave")), "node"), "tour-places")
    zero = F.lit(0).cast("bigint")
    entered = placed.select("node", F.lit(-1).alias("sign"), F.col("enter").alias("place"),
                            (F.col("leave") == F.col("enter") + 1).cast("bigint").alias("leaves"),
                            ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    left = placed.select("node", F.lit(1).alias("sign"), F.col("leave").alias("place"), zero.alias("leaves"), zero.alias("saved"))
    sums = _running(entered.unionByName(left), [], "place", {"to_leaves": "leaves", "to_saved": "saved"})
    # an exit has the sum with its subtree, an enter (less its own weight) the sum before it
    return sums.groupBy("node").agg(F.sum(F.col("sign") * (F.col("to_leaves") - F.col("leaves"))).alias("n_leaves"),
                                    F.sum(F.col("sign") * (F.col("to_saved") - F.col("saved"))).alias("saved_tokens"))


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 of the decimal ids that end at a node, ascending, joined by commas."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, done = None, None, []

        def out():
            return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done])],
                                              ["node", "ends_sha256"])

        for batch in batches:
            own, ids = batch.column(0).to_numpy(), batch.column(1)
            cuts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else []
            for a, b in zip(cuts, [*cuts[1:], len(own)]):
                told = ",".join(map(str, ids.slice(a, b - a).to_pylist())).encode()
                if node is not None and own[a] == node:
                    digest.update(b"," + told)
                    continue
                if node is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = int(own[a]), hashlib.sha256(told)
            if len(done) > 4096:
                yield out()
                done = []
        if node is not None:
            done.append((node, digest.hexdigest()))
        if done:
            yield out()

    return shipped(ends).repartition("node").sortWithinPartitions("node", "conv_id").mapInArrow(run, "node bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame, group: int = GROUP, chunk: int = CHUNK_ARCS) -> DataFrame:
    """One row per node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    rebuilt, lengths = rebuild(turns, group)
    nodes, ends = trie_nodes(rebuilt, lengths)
    ranks = rank(tour(nodes), chunk)
    sums = subtree_sums(nodes, ranks)
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    none = hashlib.sha256(b"").hexdigest()
    out = nodes.join(sums, "node").join(children, "node", "left").join(end_digests(ends), "node", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
                      "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
