"""Spelling variants by a dictionary of trie-node pairs.

Words are the distinct results of the noted runs that are long and frequent enough. In sorted order they
make a trie, whose nodes are numbered in that order; sorted by their reversals they make the trie of
suffixes. So a word of length m has m + 1 prefix nodes P and m + 1 suffix nodes S, and

* ``(P[i], S[m-i])`` is the word itself, cut at i: one word a pair,
* ``(P[i], S[m-i-1])`` is the word with position i skipped: words that share it differ there alone.

Words that meet on a skipped pair are replacements of each other (a word each of one letter, so at most
an alphabet of them); a word whose cut pair is a skipped pair of another is that word less one letter,
counted where the skipped letter starts a run of equal letters, so once. Node numbers are exact, so
neighbours need no comparison of texts. Pairs of words are never written: a pair's members are counted and its
two best kept by windows, and each word sums up its pairs.

Numbering: words are range-partitioned by code point, so equal prefixes are next to each other; a task numbers
the prefixes that the word before lacks, and the prefixes that reach over a task's start get their numbers
from the last word of the tasks before (one row a task, passed through in order). A number is task number
x 2^40 + a count, so words have the numbers of their last nodes in code-point order.

Defined cases: a null text has no runs; a null id counts as an empty one in the noted hash; repeated rows count
their runs each; a very long run is a word like any other (its nodes grow with its length, nothing with the
square of it), very long texts are read in blocks; other columns are ignored; an empty table gives no rows;
of near words with equal counts the first by code point is the form.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderpulse.llm.common import arrow_rows, shipped, stored

LEAST_LETTERS, LEAST_COUNT, FACTOR = 5, 3, 2
NOTED = 97
BLOCK_CHARS = 1 << 20
HELD_WORDS = 400_000         # words that a task counts before it hands them on
PART = 40                    # bits of a node number below its task's number
_RUN = re.compile("[a-zÀ-ÿ]+")
_GAP = re.compile("[^a-zÀ-ÿ]")


def noted_runs(doc_id: int | None, text: str) -> Iterator[Counter]:
    """Runs of the text with A-Z lower-cased, counted by blocks, each as it is noted: where ``NOTED`` divides the
    crc32 h of ``<id>:<run>``, without the code point h modulo length."""
    low = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    seed = zlib.crc32(b"%d:" % doc_id if doc_id is not None else b":")
    at = 0
    while at < len(low):
        gap = _GAP.search(low, at + BLOCK_CHARS) if len(low) > at + BLOCK_CHARS else None
        end = gap.start() if gap else len(low)
        runs, out = Counter(_RUN.findall(low, at, end)), Counter()
        for run, n in runs.items():
            h = zlib.crc32(run.encode(), seed)
            if h % NOTED == 0:
                cut = h % len(run)
                run = run[:cut] + run[cut + 1:]
            out[run] += n
        yield out
        at = end


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = LEAST_LETTERS,
                least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all words with so many letters and occurrences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        chars = 0

        def out():
            words, n = list(held), list(held.values())
            for at in range(0, len(words), 1 << 15):
                yield pa.RecordBatch.from_arrays([pa.array(words[at:at + (1 << 15)], pa.string()), pa.array(n[at:at + (1 << 15)], pa.int64())],
                                                 ["word", "n"])
            held.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                for part in noted_runs(doc_id, text) if text else ():
                    for word, n in part.items():
                        if len(word) >= least_letters:
                            if word in held:
                                held[word] += n
                            else:
                                held[word] = n
                                chars += len(word)
                    if len(held) > HELD_WORDS or chars > 16 * HELD_WORDS:
                        yield from out()
                        chars = 0
        yield from out()

    two = shipped(docs).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counted = two.mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _common(a: str, b: str) -> int:
    return len(commonprefix((a, b)))


def number_nodes(words: DataFrame, name: str, reverse: bool = False) -> DataFrame:
    """(word, <name>): the trie nodes of each word's prefixes from the empty one to the whole word; with
    ``reverse`` those of its suffixes, by length."""
    key = F.reverse("word") if reverse else F.col("word")
    ranged = stored(shipped(words).select("word", key.alias("key")).repartitionByRange("key").sortWithinPartitions("key")
                    .withColumn("part", F.spark_partition_id()), f"trie-{name}")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """First and last word of each part of the range, and the last one's nodes: those that a word's part
        numbered, by count; 0 where the first word of the part has the node too."""
        part, first, last, path, count = None, "", "", [], 0

        def row():
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([first]), pa.array([last]),
                                               pa.array([path], pa.list_(pa.int64()))], ["part", "first", "last", "path"])

        for batch in batches:
            for word, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if p != part:
                    if part is not None:
                        yield row()
                    part, first, last, count = p, word, word, len(word)
                    path = [0] * len(word)  # the first word's own nodes count 1, 2, ...
                    continue
                same = _common(last, word)
                path = path[:same] + list(range(count + 1, count + 1 + len(word) - same))
                count += len(word) - same
                last = word
        if part is not None:
            yield row()

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each part the nodes of its first word that earlier parts have numbered."""
        before, nodes = "", []
        for batch in batches:
            for r in batch.to_pylist():
                given = nodes[:_common(before, r["first"])]
                yield pa.RecordBatch.from_arrays([pa.array([r["part"]], pa.int32()), pa.array([given], pa.list_(pa.int64()))],
                                                 ["part", "given"])
                base = r["part"] << PART
                # a node of the last word that the first one has: given from before, or the first word's own
                own = [base + c if c else given[d] if d < len(given) else base + d + 1 for d, c in enumerate(r["path"])]
                before, nodes = r["last"], own

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, path, count = None, "", [], 0
        for batch in batches:
            out = []
            for k, (word, p) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                if p != part:
                    base, part = p << PART, p
                    given = batch.column(3)[k].as_py()
                    count = len(word)
                    path = given + list(range(base + len(given) + 1, base + count + 1))
                else:
                    same = _common(last, word)
                    path = path[:same] + list(range(base + count + 1, base + count + 1 + len(word) - same))
                    count += len(word) - same
                last = word
                out.append([0, *path])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64()))], ["word", name])

    def one_file_a_part(df: DataFrame) -> DataFrame:
        # parts of the stored range come back whole, in order, whichever files a task reads
        return df.repartition("part").sortWithinPartitions("part", "key")

    tails = one_file_a_part(ranged).select("key", "part").mapInArrow(ends, "part int, first string, last string, path array<bigint>")
    with arrow_rows(words.sparkSession, 256):
        given = stored(tails.coalesce(1).sortWithinPartitions("part").mapInArrow(carry, "part int, given array<bigint>"), f"carry-{name}")
    # a part's rows are in order, so its first one is where its given nodes are needed; the table has one row a part
    first = ranged.groupBy("part").agg(F.min("key").alias("key"))
    given = given.join(first, "part").select(F.col("key").alias("first_key"), "given")
    keyed = ranged.join(F.broadcast(given), F.col("key") == F.col("first_key"), "left")
    return one_file_a_part(keyed.select("word", "key", "part", "given")).select("word", "key", "part", "given").mapInArrow(
        number, f"word string, {name} array<bigint>")


def node_pairs(dictionary: DataFrame) -> DataFrame:
    """(p, s, kind, wid, n): the pairs of every word of (word, n, pre, suf). Kind 0: the word cut; 1: a letter
    skipped; 2: a letter skipped that starts a run of equal ones."""
    names = ["p", "s", "kind", "wid", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            pre, suf = batch.column(2), batch.column(3)
            held, size = [], 0

            def out():
                return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names)

            for k, word in enumerate(words):
                m = len(word)
                p, s = np.array(pre[k].values, np.int64), np.array(suf[k].values, np.int64)[::-1]
                letters = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32)
                kind = 1 + np.r_[True, letters[1:] != letters[:-1]].astype(np.int8)
                held.append((np.r_[p, p[:-1]], np.r_[s, s[1:]], np.r_[np.zeros(m + 1, np.int8), kind],
                             np.full(2 * m + 1, p[-1]), np.full(2 * m + 1, n[k])))
                size += 2 * m + 1
                if size > 1 << 16:
                    yield out()
                    held, size = [], 0
            if held:
                yield out()

    return dictionary.select("word", "n", "pre", "suf").mapInArrow(run, "p bigint, s bigint, kind tinyint, wid bigint, n bigint")


def near_words(pairs: DataFrame) -> DataFrame:
    """(wid, n_near, best): for words with near ones their number, and (n, -wid) of the most frequent."""
    group = W.partitionBy("p", "s")
    # a pair has at most one cut word, and of skipped ones an alphabet of last letters
    ordered = group.orderBy(F.col("kind") == 0, F.desc("n"), "wid")
    whole = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    me = F.struct("n", (-F.col("wid")).alias("neg"))
    skipped, starts, cut = F.col("kind") > 0, F.col("kind") == 2, F.col("kind") == 0
    none = F.lit(None).cast("struct<n:bigint,neg:bigint>")
    seen = pairs.select("*", F.row_number().over(ordered).alias("place"),
                        F.first(F.when(skipped, me)).over(whole).alias("one"),
                        F.nth_value(F.when(skipped, me), 2).over(whole).alias("two"),
                        F.count(F.when(skipped, 1)).over(whole).alias("n_skipped"),
                        F.count(F.when(starts, 1)).over(whole).alias("n_starts"),
                        F.max(F.when(starts, me)).over(whole).alias("top"),
                        F.max(F.when(cut, me)).over(whole).alias("cut"))
    other = F.when(F.col("place") == 1, F.col("two")).otherwise(F.col("one"))
    from_cut = F.when(starts, F.col("cut")).otherwise(none)
    found = seen.select(
        "wid",
        F.when(cut, F.col("n_starts")).otherwise(F.col("n_skipped") - 1 + from_cut.isNotNull().cast("bigint")).alias("n_near"),
        F.when(cut, F.col("top")).otherwise(F.greatest(other, from_cut)).alias("best")).where("n_near > 0")
    return found.groupBy("wid").agg(F.sum("n_near").alias("n_near"), F.max("best").alias("best"))


def forms(dictionary: DataFrame, near: DataFrame, factor: int = FACTOR) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of (word, n, wid)."""
    rows = dictionary.join(near, "wid", "left").select(
        "wid", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(F.col("best.n") >= factor * F.col("n"), -F.col("best.neg")).alias("form"),
        F.when(F.col("best.n") >= factor * F.col("n"), F.col("best.n")).alias("form_n"))
    rows = stored(rows, "spelling-forms")
    # each form is factor times as frequent, so a chain has a few ten words at most; steps double
    step = rows.where("form is not null").select("wid", F.col("form").alias("root"))
    while True:
        step = stored(step, "spelling-roots")
        on = step.select(F.col("wid").alias("at"), F.col("root").alias("next"))
        moved = stored(step.join(on, step.root == on["at"], "left").select(
            "wid", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-steps")
        step = moved.select("wid", "root")
        if not moved.where("moved").limit(1).count():
            break
    names = rows.select(F.col("wid").alias("of"), F.col("word").alias("name"))
    named = rows.join(step, "wid", "left")
    named = named.join(names.select(F.col("of").alias("form"), F.col("name").alias("form_word")), "form", "left")
    named = named.join(names.select(F.col("of").alias("root"), F.col("name").alias("root_word")), "root", "left")
    return named.select("word", "n", "n_near", F.col("form_word").alias("form"), "form_n",
                        F.coalesce("root_word", "word").alias("root"))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = LEAST_LETTERS,
                      least_count: int = LEAST_COUNT, factor: int = FACTOR) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the texts."""
    words = stored(count_words(docs, id_col, text_col, least_letters, least_count), "words")
    pre, suf = number_nodes(words, "pre"), number_nodes(words, "suf", reverse=True)
    dictionary = stored(words.join(pre, "word").join(suf, "word").withColumn("wid", F.element_at("pre", -1)), "dictionary")
    with arrow_rows(docs.sparkSession, 2048):
        near = stored(near_words(node_pairs(shipped(dictionary))), "near-words")
    return forms(dictionary.select("word", "n", "wid"), near, factor)
