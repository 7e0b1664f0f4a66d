"""Quality classifier: regularised quadratic discriminant analysis.

Each text becomes a vector of transformed statistics (logs and log-odds, so that classes are nearer to
normal). Class means and covariances come from moments summed over all labelled rows of the learning
folds; each covariance is shrunk towards the pooled one and then towards a multiple of the identity.
The score is the logistic function of the difference of the two Mahalanobis log densities (plus log
priors), with each class's Cholesky factor computed once and shipped to the tasks.

Defined cases: null and empty texts have the statistics of no words and are scored like any other;
a repeated row is scored as often as it occurs; an id with several labels counts with the least; rows
without a label (or id) are scored and never learnt from; when a class has no labelled rows, every
score is the prior share of label 1 (0.5 without labels); other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import row_hash, shipped, stored

FEATURES = ("words", "upper", "marks", "symbols", "digits", "word_length", "distinct", "top_word", "bigrams",
            "lines", "line_length", "marked_words", "capital_words", "bars")
SHRINK_POOLED, SHRINK_IDENTITY = 0.3, 0.05
FOLDS, HELD_OUT = 5, 0

_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_MARKS, _SYMBOLS, _DIGITS = b".,;:!?'\"()-", b"#$%&*|+/\\<>=@[]^_`{}~", b"0123456789"


def _odds(part: float, whole: float) -> float:
    return float(np.log((part + 0.5) / (max(whole - part, 0) + 0.5)))


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a whole text, in the order of ``FEATURES``."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.lower().split()
    n, size = len(words), len(raw)
    count = lambda kinds: size - len(raw.translate(None, kinds))
    letters = count(_LETTERS)
    seen = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    pairs = len(set(zip(words, words[1:])))
    marked = sum(v for w, v in seen.items() if w[-1] in b"!#$%&*" or w == b"|")
    capital = sum(1 for w in raw.split() if w.isupper() and len(w) > 1)
    return [float(np.log1p(n)), _odds(count(_UPPER), letters), _odds(count(_MARKS), size), _odds(count(_SYMBOLS), size),
            _odds(count(_DIGITS), size), float(np.log((letters + 1) / (n + 1))),
            float(np.log((len(seen) + 1) / (n + 1) ** 0.75)), _odds(max(seen.values(), default=0), n), _odds(pairs, max(n - 1, 0)),
            _odds(len(set(lines)), len(lines)), float(np.log((n + 1) / (len(lines) + 1))), _odds(marked, n),
            _odds(capital, n), _odds(count(b"|"), n)]


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, x): the statistics of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x, pa.list_(pa.float64()))],
                                             ["doc_id", "h", "x"])

    three = shipped(docs).select(F.col(id_col).cast("bigint").alias("doc_id"), row_hash(text_col).alias("h"),
                                 F.col(text_col).alias("text"))
    return three.mapInArrow(run, "doc_id bigint, h bigint, x array<double>")


def held_out(id_col: str = "doc_id") -> F.Column:
    """Whether the row is kept from learning: crc32 of the id as text, modulo the folds."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def learning_labels(labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, y): labels 0 and 1 of the learning folds, one a document."""
    kept = labels.where(F.col(label).isin(0, 1) & ~held_out(id_col) & F.col(id_col).isNotNull())
    return kept.groupBy(F.col(id_col).cast("bigint").alias("doc_id")).agg(F.min(label).cast("int").alias("y"))


class Discriminant:
    """Two normal classes with shrunk covariances; Cholesky factors are kept inverted."""

    def __init__(self, moments: dict[int, tuple[float, np.ndarray, np.ndarray]], pooled: float = SHRINK_POOLED,
                 identity: float = SHRINK_IDENTITY):
        n = {y: m[0] for y, m in moments.items()}
        self.prior = (n.get(1, 0) / sum(n.values())) if sum(n.values()) else 0.5
        self.classes = None
        if min(n.get(0, 0), n.get(1, 0)) < 1:
            return
        mean = {y: s / k for y, (k, s, _) in moments.items()}
        cov = {y: q / k - np.outer(mean[y], mean[y]) for y, (k, _, q) in moments.items()}
        whole = sum(n[y] * cov[y] for y in cov) / sum(n.values())
        d = len(whole)
        self.classes = {}
        for y in (0, 1):
            c = (1 - pooled) * cov[y] + pooled * whole
            c = (1 - identity) * c + identity * max(np.trace(c) / d, 1e-6) * np.eye(d)
            chol = np.linalg.cholesky(c)
            self.classes[y] = (mean[y], np.linalg.inv(chol), float(np.log(np.diag(chol)).sum()),
                               float(np.log(n[y] / sum(n.values()))))

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.classes is None:
            return np.full(len(x), self.prior)
        log = {y: prior - half_log_det - 0.5 * (((x - mean) @ inverse.T) ** 2).sum(1)
               for y, (mean, inverse, half_log_det, prior) in self.classes.items()}
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def fit(rows: DataFrame, labels: DataFrame, label: str = "quality") -> Discriminant:
    """Learn from all labelled rows of the learning folds; each task sends one set of moments a class."""
    d = len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {y: np.zeros(1 + d + d * d) for y in (0, 1)}
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), float).reshape(-1, d)
            y = np.array(batch.column(0).to_pylist(), int)
            for k in (0, 1):
                z = x[y == k]
                total[k] += np.r_[len(z), z.sum(0), (z.T @ z).ravel()]
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array([total[0], total[1]], pa.list_(pa.float64()))],
                                         ["y", "m"])

    known = rows.join(learning_labels(labels, label), "doc_id").select("y", "x")
    moments = {0: np.zeros(1 + d + d * d), 1: np.zeros(1 + d + d * d)}
    # a fixed order of addition: reruns agree
    for part in sorted((r.y, tuple(r.m)) for r in shipped(known).mapInArrow(run, "y int, m array<double>").toLocalIterator()):
        moments[part[0]] += np.array(part[1])
    return Discriminant({y: (m[0], m[1:1 + d], m[1 + d:].reshape(d, d)) for y, m in moments.items()})


def score(rows: DataFrame, model: Discriminant) -> DataFrame:
    """(doc_id, h, score) from (doc_id, h, x)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(2).to_pylist(), float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(model.score(x))],
                                             ["doc_id", "h", "score"])

    return shipped(rows).select("doc_id", "h", "x").mapInArrow(run, "doc_id bigint, h bigint, score double")


def score_documents(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """(doc_id, h, score) for every row of ``docs``; texts are read once."""
    rows = stored(features(docs), "quality-features")
    return score(rows, fit(rows, labels, label))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float, label: str = "quality", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score below ``threshold``. Texts are read twice and not shuffled."""
    model = fit(features(docs, text_col=text_col), labels, label)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t.as_py()) for t in batch.column(at)], float).reshape(-1, len(FEATURES))
            yield batch.filter(pa.array(model.score(x) >= threshold))

    return shipped(docs).mapInArrow(run, docs.schema)
