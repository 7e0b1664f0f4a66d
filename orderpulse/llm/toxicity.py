"""Toxicity: Levenshtein automata intersected with a lexicon trie, and context windows.

The lexicon is learnt from labelled rows: words, and openings of words for languages that inflect,
that stand in toxic texts, outside quotations, more often than chance allows. Every word of a text, and neighbouring
words joined by a symbol, is run as a Levenshtein automaton (with swaps) against the trie of the
lexicon, which finds terms and misspellings of them.
Each hit is scored by a window of words around it: quotation marks and reporting words speak for
quotation, closeness of other hits for abuse. A logistic regression on the hit statistics of the
learning rows gives the score.

The learning rows are at most ``SAMPLE`` labelled rows (those with the smallest hash of the id, one of each id); all else
covers all rows. Defined cases: null and empty texts have no hits and get the score of a text without
hits; repeated rows are scored each; an id with several labels counts with the greatest; without
labels of both kinds every score is the share of label 1 (0 without labels); other columns are
ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import row_hash, shipped, stored
from orderpulse.llm.quality import held_out

SAMPLE = 20_000              # labelled rows that the lexicon and the regression are learnt from
OPENINGS = (4, 5, 6, 7)      # lengths of word openings that may become terms
WINDOW = 6                   # words on either side of a hit
ODDS = 8.0                   # by which a term's rate in toxic texts exceeds that in others, outside quotations
ROUNDS = 3                   # of looking for near copies, each by other minhashes
ALIKE = 0.8                  # shared part of the words of near copies
_PRIME = np.uint64(2**31 - 1)
_FACTORS = np.array([int(blake2b(bytes([k]), digest_size=4).hexdigest(), 16) % (2**31 - 2) + 1 for k in range(2 * ROUNDS)], np.uint64)
#: Reporting and mentioning words, and marks of quotation.
REPORTING = frozenset("said says wrote called quote quoted word term dit disait mot sagte wort genannt dijo palabra".split())
QUOTES = frozenset("\"“”„«»‘’'`")
_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TOKEN = re.compile(_LETTERS + r"|[\"“”„«»‘’`]")
#: Words with one or two ASCII symbols between them and no space: perhaps one word with masked letters.
_GAP = re.compile(r"([!#-/:-@\[-_{-~]{1,2})")
_CHAIN = re.compile(f"{_LETTERS}(?:{_GAP.pattern}{_LETTERS})+")
FEATURES = ("hits", "misspelt", "rate", "density", "quoted")


def tokens(text: str | None) -> list[str]:
    """Lower-cased words, and quotation marks as tokens of their own."""
    if not text:
        return []
    return _TOKEN.findall(text.lower())


def quoted_places(words: list[str]) -> list[bool]:
    """Of each word, whether it has quotation marks on both sides or a reporting word in its window."""
    before, after, told = (bytearray(len(words)) for _ in range(3))
    for i, w in enumerate(words):
        quote, reporting = w in QUOTES, w in REPORTING
        if quote or reporting:
            for j in range(max(0, i - WINDOW), i):
                after[j], told[j] = after[j] | quote, told[j] | reporting
            for j in range(i + 1, min(len(words), i + 1 + WINDOW)):
                before[j], told[j] = before[j] | quote, told[j] | reporting
    return [bool(b and a or t) for b, a, t in zip(before, after, told)]


def allowed_edits(term: str) -> int:
    """Edits under which a word still counts as a misspelling of the term."""
    n = len(term.rstrip("*"))
    return 0 if n < 4 else 1 if n < 10 else 2


def _parts(stem: str, edits: int) -> Iterator[tuple[int, int, str]]:
    """(edits left, place, part): a word within so many edits of the stem has one of the parts, at most the
    edits left away from its place. Of a stem cut in one part more than its edits, every edit changes one
    part, but a swap over a cut two: such swaps are made beforehand."""
    cuts = [len(stem) * k // (edits + 1) for k in range(edits + 2)]
    for swaps in range(2 ** edits):
        letters, left = list(stem), edits
        for k in range(edits):
            if swaps >> k & 1:
                at, left = cuts[k + 1], left - 1
                letters[at - 1], letters[at] = letters[at], letters[at - 1]
        made = "".join(letters)
        for p, q in zip(cuts, cuts[1:]) if left else [(0, len(stem))]:
            yield left, p, made[p:q]


class Trie:
    """Lexicon trie. A term that ends in ``*`` matches every word that it opens."""

    def __init__(self, terms):
        self.root: dict = {}
        parts: dict[int, dict] = {}
        for term in terms:
            node, stem, edits = self.root, term.rstrip("*"), allowed_edits(term)
            for ch in stem:
                node = node.setdefault(ch, {})
                node["most"] = max(node.get("most", 0), edits)  # edits that the terms below allow
            node["" if not term.endswith("*") else "*"] = term
            if not edits:
                continue
            for left, p, part in _parts(stem, edits):
                for n in [0] if term.endswith("*") else range(len(stem) - left, len(stem) + left + 1):
                    for at in range(max(0, p - left), p + left + 1):
                        parts.setdefault(n, {}).setdefault((at, at + len(part)), set()).add(part)
        #: by word length (0: any), [(start, end, parts)]: a misspelt word must have one of them
        self.parts = {k: [(*at, frozenset(s)) for at, s in sorted(v.items())] for k, v in parts.items()}

    def exact(self, word: str) -> str | None:
        node = self.root
        for ch in word:
            if "*" in node:
                return node["*"]
            node = node.get(ch)
            if node is None:
                return None
        return node.get("") or node.get("*")

    def fuzzy(self, word: str, narrow: bool = True) -> tuple[str, int] | None:
        """(term, edits) of the nearest term that the automaton of ``word`` accepts: one edit for terms of
        four letters, two from ten. An edit is a letter too many, too few, another, or two neighbours swapped.
        ``narrow``: the first letter must agree, terms have five letters and a swap is two edits."""
        for n in (len(word), 0):
            if any([word[i:j] in parts for i, j, parts in self.parts.get(n, ())]):
                break
        else:
            return None
        node, rest = (self.root.get(word[:1]), word[1:]) if narrow else (self.root, word)
        if node is None:
            return None
        best: tuple[str, int] | None = None
        # the automaton's state is the row of edit distances of the letters read so far, and for swaps the
        # last letter and the row before it
        stack = [(node, list(range(len(rest) + 1)), "", [])]
        while stack:
            node, row, last, before = stack.pop()
            limit = 2 if best is None else best[1] - 1
            for end in ("", "*"):
                if end in node:
                    edits = row[-1] if not end else min(row)
                    if edits <= min(limit, allowed_edits(node[end])) and len(node[end].rstrip("*")) > (4 if narrow else 3):
                        best, limit = (node[end], edits), edits - 1
            for ch, child in node.items():
                if len(ch) != 1 or ch == "*":
                    continue
                most = min(limit, child["most"])
                new = [row[0] + 1]
                for i, c in enumerate(rest):
                    new.append(min(new[i] + 1, row[i + 1] + 1, row[i] + (c != ch)))
                    if i and before and not narrow and c == last and rest[i - 1] == ch:
                        new[-1] = min(new[-1], before[i - 1] + 1)
                if min(new) <= most or not narrow and min(row) < most:
                    stack.append((child, new, ch, row))
        return best


class Matcher:
    """Hit statistics of texts for a lexicon; ``known`` are look-alike words of harmless texts."""

    def __init__(self, terms, known=()):
        self.trie, self.known = Trie(terms), frozenset(known)
        self.seen: set[str] = set()  # words looked up
        self.found: dict[str, tuple[str, int]] = {}  # those that are hits

    def look_up(self, words: set[str]) -> bool:
        """Whether any of the words is a hit; ``found`` then has it."""
        if len(self.seen) > 500_000:
            self.seen.clear()
        for w in words - self.seen:
            self.seen.add(w)
            term = self.trie.exact(w)
            got = (term, 0) if term else None if w in self.known else self.trie.fuzzy(w, narrow=False)
            if got:
                self.found[w] = got
        return not self.found.keys().isdisjoint(words)

    def hits(self, text: str | None, words: list[str]) -> list[tuple[int, str, int]]:
        """(place, word, edits) of the words of the text that are terms or misspellings of them, and of words
        that are so only with the symbols inside them."""
        out = [(i, w, self.found[w][1]) for i, w in enumerate(words) if w in self.found] if self.look_up(set(words)) else []
        chains = [(m.start(), _GAP.split(m.group())) for m in _CHAIN.finditer(text.lower())] if words else []
        # every symbol is an edit, so at most two
        whole = [(start, bits, k, n, "".join(bits[k:k + n])) for start, bits in chains for n in (3, 5)
                 for k in range(0, len(bits) - n + 1, 2) if n == 3 or len(bits[k + 1]) + len(bits[k + 3]) == 2]
        if self.look_up({w for *_, w in whole}):
            hit, starts = {i for i, *_ in out}, [m.start() for m in _TOKEN.finditer(text.lower())]
            for start, bits, k, n, w in whole:
                if w in self.found:
                    at = bisect_left(starts, start) + k // 2
                    places = range(at, at + n // 2 + 1)
                    if hit.isdisjoint(places):
                        hit.update(places)
                        out.append((at, w, self.found[w][1]))
            out.sort()
        return out

    def statistics(self, text: str | None) -> list[float]:
        words = tokens(text)
        hits = self.hits(text, words)
        exact = misspelt = quoted = density = 0.0
        at, is_quoted = [i for i, _, _ in hits], quoted_places(words) if hits else []
        for k, (i, _, edits) in enumerate(hits):
            near = sum(1 for j in at[max(0, k - WINDOW):k + WINDOW + 1] if j != i and abs(j - i) <= WINDOW)
            if is_quoted[i] and not near:
                quoted += 1
            elif edits:
                misspelt += 1
            else:
                exact += 1
            density = max(density, near)
        n = max(len(words), 1)
        return [math.log1p(exact), math.log1p(misspelt), math.log1p(1000 * (exact + misspelt / 2) / (n + 50)),
                math.log1p(density), math.log1p(quoted)]


def learning_rows(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, y) of the learning rows, at most ``sample``: of the rows of an id the one with the smallest
    hash of the text. Labels are at most as many, so they can be broadcast."""
    known = labels.where(F.col(label).isin(0, 1) & ~held_out(id_col) & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).cast("bigint").alias("doc_id")).agg(F.max(label).cast("int").alias("y"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    found = texts.join(F.broadcast(known), "doc_id")
    return found.groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.max("y").alias("y"))


def _terms_of(text: str | None) -> set[str]:
    """Words of a text that stand outside quotations, and their openings."""
    every = tokens(text)
    words = {w for w, quoted in zip(every, quoted_places(every)) if not quoted and any(map(str.isalpha, w))}
    return words | {w[:k] + "*" for w in words for k in OPENINGS if len(w) >= k}


def minhashes(words: set[str]) -> list[int]:
    """``ROUNDS`` marks of a word set, each of two minima: sets that share most words often agree in one."""
    h = np.array([crc32(w.encode("utf-8", "surrogatepass")) for w in words] or [0], np.uint64)
    low = [int(((h * odd + np.uint64(1)) % _PRIME).min()) for odd in _FACTORS]
    return [a << 31 | b for a, b in zip(low[::2], low[1::2])]


def near_copies(a: set[str], b: set[str]) -> bool:
    """Word sets that share at least ``ALIKE`` of their words."""
    return len(a & b) >= ALIKE * len(a | b)


def one_of_copies(rows: DataFrame) -> DataFrame:
    """One row (text, y) of the rows of a label that have the same word set, and of near copies: in every
    round a text falls to the smallest text with the same two minhashes, if their word sets are alike.
    All other texts stay."""
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [set(tokens(text)) for text in batch.column(0).to_pylist()]
            keys = [blake2b("\n".join(sorted(w)).encode("utf-8", "surrogatepass"), digest_size=16).digest() for w in sets]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary()),
                                              pa.array([minhashes(w) for w in sets], pa.list_(pa.int64()))],
                                             ["text", "y", "words", "marks"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [first is None or first == text or not near_copies(set(tokens(text)), set(tokens(first)))
                    for text, first in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist())]
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1, 2])

    marked = shipped(rows).select("text", "y").mapInArrow(mark, "text string, y int, words binary, marks array<bigint>")
    kept = marked.groupBy("y", "words").agg(F.min(F.struct("text", "marks")).alias("r")).select("r.text", "y", "r.marks")
    for k in range(ROUNDS):
        kept = stored(kept, "toxic-copies")
        by = kept.withColumn("mark", F.col("marks")[k])
        first = by.groupBy("y", "mark").agg(F.min("text").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
        kept = (by.join(first, ["y", "mark"], "left").select("text", "y", "marks", "first")
                .mapInArrow(others, "text string, y int, marks array<bigint>"))
    return kept.select("text", "y")


def learn_lexicon(rows: DataFrame, size: int | None = None) -> list[str]:
    """Terms whose share of toxic texts is out of reach of chance, those with the most evidence first; uses in
    quotations count for neither side. ``rows`` have each text once: else a toxic text with many copies would
    make all its words look toxic. ``size``: only so many terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[y].update(_terms_of(text))
        terms = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([counts[0][t] for t in terms], pa.int64()),
                                          pa.array([counts[1][t] for t in terms], pa.int64())], ["term", "n0", "n1"])

    n = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    if not n.get(0) or not n.get(1):
        return []
    base = n[1] / (n[0] + n[1])
    summed = shipped(rows).select("text", "y").mapInArrow(run, "term string, n0 bigint, n1 bigint")
    summed = stored(summed.groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "toxic-terms")
    # by chance n1 of a term's rows and no fewer are toxic with a probability of e ^ -evidence at most
    share = F.col("n1") / (F.col("n0") + F.col("n1"))
    evidence = F.col("n1") * F.log(share / base) + F.when(F.col("n0") > 0, F.col("n0") * F.log((1 - share) / (1 - base))).otherwise(0)
    found = (summed.where(f"n1 >= 3 and n1 * {float(n[0])}D >= {ODDS}D * n0 * {float(n[1])}D").withColumn("evidence", evidence)
             .where(F.col("evidence") >= math.log(max(summed.count(), 2)))
             .collect())  # terms of at most the sample's texts
    # of terms that the same texts make, the most particular: the word before its openings, the longest of these
    chosen: dict[str, int] = {}
    openings: set[str] = set()
    for r in sorted(found, key=lambda r: (-r.evidence, r.term.endswith("*"), -len(r.term), r.term)):
        stem = r.term.rstrip("*")
        if any(stem[:k] in openings for k in range(OPENINGS[0], len(stem) + 1)) or any(
                t.startswith(stem) and n >= 0.9 * r.n1 for t, n in chosen.items()):
            continue
        chosen[r.term] = r.n1
        if r.term.endswith("*"):
            openings.add(stem)
        if len(chosen) == size:
            break
    return list(chosen)


def look_alikes(rows: DataFrame, terms: list[str]) -> list[str]:
    """Words that the automata accept but that harmless rows use outside quotations, in more than one row and
    at no smaller rate than toxic rows: words of the language, not misspellings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, counts = Matcher(terms), (Counter(), Counter())
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = tokens(text)
                if hits := [h for h in matcher.hits(text, words) if h[2]]:
                    quoted = quoted_places(words)
                    counts[y].update({w for i, w, _ in hits if not quoted[i]})
        found = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([counts[0][w] for w in found], pa.int64()),
                                          pa.array([counts[1][w] for w in found], pa.int64())], ["word", "n0", "n1"])

    n = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    found = shipped(rows).select("text", "y").mapInArrow(run, "word string, n0 bigint, n1 bigint")
    found = found.groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    known = found.where(f"n0 >= 2 and n0 * {float(n.get(1, 0))}D >= n1 * {float(n.get(0, 0))}D")
    return sorted(r.word for r in known.collect())  # words of at most the sample's texts


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights (the last is the constant) of a ridge-penalised logistic regression, by Newton steps."""
    a = np.c_[x, np.ones(len(x))]
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hess = a.T @ (a * (p * (1 - p))[:, None]) / len(a) + np.diag([ridge] * x.shape[1] + [1e-9])
        step = np.linalg.solve(hess, a.T @ (p - y) / len(a) + np.r_[ridge * w[:-1], 0])
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return w


class Model:
    def __init__(self, terms=(), known=(), weights=None, prior: float = 0.0):
        self.terms, self.known, self.weights, self.prior = list(terms), list(known), weights, prior

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(np.c_[x, np.ones(len(x))] @ self.weights, -700, 700)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Model:
    rows = stored(learning_rows(docs, labels, label, sample), "toxic-learning")
    once = stored(one_of_copies(rows), "toxic-texts")
    terms = learn_lexicon(once)
    known = look_alikes(once, terms) if terms else []
    x = [(r.x, r.y) for r in hit_statistics(rows, terms, known, "y").select("x", "y").collect()]  # at most the sample
    y = np.array([v for _, v in x], float)
    if not len(y) or y.min() == y.max():
        return Model(terms, known, None, float(y.mean()) if len(y) else 0.0)
    order = sorted(range(len(x)), key=lambda i: (x[i][0], x[i][1]))
    return Model(terms, known, fit_logistic(np.array([x[i][0] for i in order], float), y[order]))


def hit_statistics(rows: DataFrame, terms: list[str], known: list[str], *keep: str, text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and ``x``, the hit statistics of every whole text."""
    held = rows.sparkSession.sparkContext.broadcast((terms, known))
    kept = rows.select(*keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(*held.value)
        for batch in batches:
            x = [matcher.statistics(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(x, pa.list_(pa.float64()))], [*keep, "x"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), "x array<double>"])
    return shipped(rows).select(F.col(text_col), *keep).mapInArrow(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, score) for every row of ``docs``."""
    model = fit(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), labels, label, sample)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), row_hash(text_col).alias("h"), F.col(text_col).alias("text"))
    found = hit_statistics(rows, model.terms, model.known, "doc_id", "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(2).to_pylist(), float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(model.scores(x))],
                                             ["doc_id", "h", "score"])

    return found.mapInArrow(run, "doc_id bigint, h bigint, score double")
