"""Language identification: script ranges, per-word scores, Viterbi over the words.

A word is a letter with the letters and combining marks after it, cut where the script changes. The
script of a letter is its code range (``SCRIPTS``; all others are one script of their own). A language is
a candidate for a script where at least ``LEAST_SHARE`` of its learnt letters are in it; a script that no
language was learnt with leaves all of them. A word's score for a language is the log-likelihood of its
character trigrams (a space before and after) and of the whole word, as a log posterior over the
candidates, no lower than ``FLOOR``; the others have ``OUTSIDE``. Viterbi finds the labels of all words of a text with the greatest sum
of scores less ``SWITCH`` for every change of language; runs of a label are the spans.

The predicted language is the one with most letters in its spans (ties: the first by code point). The
score is the share of the letters that it has, times the posterior of the language over its words.

Learning counts n-grams over all labelled texts, in tasks (counts per language and hash bucket), so it
grows with the input; the model is one table of languages x buckets (``TABLE`` floats at most, 16 MB,
whatever the corpus), which is what tasks are sent.

Defined cases: a text that is null or without a letter is ``und`` with score 0 and no spans, and so is
every text where nothing was learnt (no labelled text with a letter); a null language is not learnt from, an
empty one is a language; a null id is learnt from and scored like any other; repeated rows each count and
are each scored; very long texts are worked on in blocks of words; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import shipped

FOLDS, HELD_OUT = 4, 2
LEAST_SHARE = 0.01
SWITCH, FLOOR, OUTSIDE = 6.0, -6.0, -30.0
TABLE, MOST_BUCKETS, LEAST_BUCKETS = 1 << 22, 1 << 17, 1 << 10
BLOCK_CHARS = 1 << 18
PASS_BYTES = 1 << 23
UND = "und"
# fixed values: first and last code point of the main ranges of each script, from the Unicode block names
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),),
    "tamil": ((0xB80, 0xBFF),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF),),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF)),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)),
}
OUT_SCHEMA = "lang_pred string, score double, spans array<struct<start:bigint,end:bigint,lang:string>>"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
_TABLES: list = []


def held_out(id_col: str = "doc_id") -> F.Column:
    """Whether the row is kept from learning."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(kind, script) of every code point: kind 0 other, 1 letter, 2 combining mark."""
    if not _TABLES:
        kind = np.zeros(0x110000, np.uint8)
        for c in range(0x110000):
            k = unicodedata.category(chr(c))[0]
            if k == "L":
                kind[c] = 1
            elif k == "M":
                kind[c] = 2
        script = np.zeros(0x110000, np.uint8)
        for s, ranges in enumerate(SCRIPTS.values(), 1):
            for first, last in ranges:
                script[first:last + 1] = s
        _TABLES.extend((kind, script))
    return _TABLES[0], _TABLES[1]


@dataclass
class Words:
    """Words of some texts: code points of all, and where each word lies."""

    points: np.ndarray   # code points of the joined texts, lower case; 0 between texts
    start: np.ndarray    # first and last (exclusive) place of each word in points
    end: np.ndarray
    script: np.ndarray
    letters: np.ndarray  # letters (no marks) in each word
    ends: np.ndarray     # where each text ends in points, the 0 after it included

    def text_of(self) -> np.ndarray:
        """Number of the text that each word is in."""
        return np.searchsorted(self.ends, self.start, side="right")


def _lower(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


def find_words(texts: list[str]) -> Words:
    """Words of the texts, in order; every text ends with a 0."""
    raw = "".join(_lower(t) + "\0" for t in texts).encode("utf-32-le", "surrogatepass")
    ends = np.cumsum([len(t) + 1 for t in texts])
    points = np.frombuffer(raw, np.uint32)
    kinds, scripts = _tables()
    kind = kinds[points]
    script = scripts[points]
    marks = np.flatnonzero(kind == 2)
    if len(marks):  # a mark belongs to the word that it follows, with its script
        inside = kind > 0
        at = np.arange(len(points))
        base = np.maximum.accumulate(np.where(kind != 2, at, 0))
        inside[marks] = kind[base[marks]] == 1
        script = np.where(kind == 2, script[base], script)
    else:
        inside = kind == 1
    before = np.r_[False, inside[:-1]]
    changed = np.r_[True, script[1:] != script[:-1]]
    start = np.flatnonzero(inside & (~before | changed))
    after = np.r_[inside[1:], False]
    end = np.flatnonzero(inside & (~after | np.r_[changed[1:], True])) + 1
    count = np.r_[0, np.cumsum(kind == 1)]
    return Words(points, start, end, script[start], count[end] - count[start], ends)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def grams(words: Words, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each n-gram, number of the first n-gram of each word): a word of m code points has m
    trigrams around its letters and itself as a whole; trigrams have the lower half of the buckets."""
    size = words.end - words.start
    first = np.cumsum(size + 1) - (size + 1)
    word = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(word)) + np.repeat(words.start - (np.cumsum(size) - size), size)
    p = words.points.astype(np.uint64)
    here = p[place]
    one, space = np.uint64(1), np.uint64(32)
    left = np.where(place == words.start[word], space, p[np.maximum(place, 1) - 1])
    right = np.where(place == words.end[word] - 1, space, p[np.minimum(place + 1, len(p) - 1)])
    tri = (left << np.uint64(42)) | (here << np.uint64(21)) | right
    half = np.uint64(buckets // 2 - 1)
    out = np.empty(len(word) + len(size), np.int64)
    out[np.arange(len(word)) + word] = (_mix(tri) & half).astype(np.int64)
    # whole word: a polynomial of its code points, wrapping at 64 bits
    step = place - words.start[word]
    power = np.cumprod(np.full(int(size.max()) if len(size) else 1, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)
    whole = np.add.reduceat((here + one) * power[step], np.cumsum(size) - size) if len(size) else np.zeros(0, np.uint64)
    out[first + size] = ((_mix(whole) & half) + half + one).astype(np.int64)
    return out, first


def _blocks(texts: list[str], most: int) -> Iterator[tuple[list[int], list[str]]]:
    """(indices, texts) of at most about so many characters; a longer text is cut between words."""
    who, part, size = [], [], 0
    for i, t in enumerate(texts):
        at = 0
        while at < len(t):
            if size >= most:
                yield who, part
                who, part, size = [], [], 0
            end = min(len(t), at + most - size)
            if end < len(t):
                while end < len(t) and not t[end].isspace() and end < at + 2 * most:
                    end += 1
            who.append(i)
            part.append(t[at:end])
            size += end - at
            at = end
    if part:
        yield who, part


def buckets_for(languages: int) -> int:
    """Hash buckets of a model, a power of two: the whole table has ``TABLE`` floats at most."""
    most = max(LEAST_BUCKETS, TABLE // max(languages, 1))
    return min(MOST_BUCKETS, 1 << (most.bit_length() - 1))


@dataclass
class Model:
    langs: list[str]          # by code point
    weights: np.ndarray       # float32 [buckets, languages]: log-likelihood of each n-gram
    allowed: np.ndarray       # bool [scripts, languages]

    def emissions(self, words: Words) -> np.ndarray:
        """Log posterior of each language for each word alone, over its script's candidates."""
        n, k = len(words.start), len(self.langs)
        out = np.zeros((n, k), np.float32)
        size = words.end - words.start + 1
        at, step = 0, max(1, (1 << 22) // (k * 8))
        while at < n:  # so many words at once that their n-grams take a few ten MB
            end = max(at + 1, int(np.searchsorted(np.cumsum(size[at:at + step]), step)) + at)
            part = Words(words.points, words.start[at:end], words.end[at:end], words.script[at:end], words.letters[at:end], words.ends)
            bucket, first = grams(part, len(self.weights))
            out[at:end] = np.add.reduceat(self.weights[bucket], first, axis=0)
            at = end
        allowed = self.allowed[words.script]
        out[~allowed] = -np.inf
        out -= out.max(1, keepdims=True, initial=-1e30)
        out -= np.log(np.exp(out).sum(1, keepdims=True))
        return np.where(allowed, np.maximum(out, FLOOR), np.float32(OUTSIDE))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """The model of all rows with a language that are not held out; None where there is no letter."""
    rows = shipped(docs).where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col))
    names = [r[0] for r in rows.select(F.col(lang_col).cast("string")).distinct().orderBy(F.col(lang_col).cast("string")).collect()]
    buckets = buckets_for(len(names))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one dense table of a task: languages x (buckets, and the letters of each script)
        number: dict[str, int] = {}
        wide = buckets + 32
        have = np.zeros(0, np.int64)
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for who, part in _blocks(texts, BLOCK_CHARS):
                words = find_words(part)
                if not len(words.start):
                    continue
                ids = np.array([number.setdefault(langs[i], len(number)) for i in who], np.int64)
                if len(number) * wide > len(have):
                    have = np.r_[have, np.zeros(len(number) * wide - len(have), np.int64)]
                lang = ids[words.text_of()]
                bucket, first = grams(words, buckets)
                bucket += np.repeat(lang * wide, np.diff(np.r_[first, len(bucket)]))
                have += np.bincount(bucket, minlength=len(have))
                have += np.bincount(lang * wide + buckets + words.script, words.letters, len(have)).astype(np.int64)
        named = pa.array(list(number), pa.string())
        full = np.flatnonzero(have)
        for at in range(0, len(full), 1 << 16):
            c = full[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([named.take(pa.array(c // wide)), pa.array((c % wide).astype(np.int32)), pa.array(have[c])],
                                             ["lang", "bucket", "n"])

    counted = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).mapInArrow(
        count, "lang string, bucket int, n bigint")
    # at most languages x buckets rows, whatever the corpus
    got = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(got.column("lang").to_pylist()))
    if not langs:
        return None
    at = {name: i for i, name in enumerate(langs)}
    counts = np.zeros((buckets + 32, len(langs)))
    counts[got.column("bucket").to_numpy(), [at[v] for v in got.column("lang").to_pylist()]] = got.column("n").to_numpy()
    scripts, counts = counts[buckets:], counts[:buckets]
    allowed = scripts >= LEAST_SHARE * np.maximum(scripts.sum(0), 1)
    allowed &= scripts > 0
    allowed[~allowed.any(1)] = True
    weights = np.empty((buckets, len(langs)), np.float32)
    for half in (slice(0, buckets // 2), slice(buckets // 2, buckets)):
        c = counts[half]
        # a bucket that a language lacks has the corpus's rate, shared out and thinned
        rate = (c.sum(1, keepdims=True) + 0.5) / (c.sum() + 0.5 * len(c))
        weights[half] = np.log((c + 0.5 * len(c) * rate * 0.1) / (c.sum(0) + 0.5 * len(c) * 0.1)) - np.log(rate)
    return Model(langs, weights, allowed)


def viterbi(scores: np.ndarray, begin: np.ndarray, end: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Label of every row of ``scores``, for sequences ``begin:end`` of it at once: the labels with the
    greatest sum of scores less ``switch`` a change (ties: no change, then the first label)."""
    n, k = scores.shape
    order = np.argsort(begin - end, kind="stable")  # longest first
    b, size = begin[order], (end - begin)[order]
    b, size = b[size > 0], size[size > 0]
    came = np.zeros((n, k), bool)                    # came from the best label rather than from itself
    best = np.zeros(n, np.int32)                     # best label at each row
    labels = np.zeros(n, np.int32)
    if not len(b):
        return labels
    longer = np.searchsorted(-size, -np.arange(int(size[0])), side="left").tolist()  # sequences longer than each step
    rows = np.arange(len(b))
    value = scores[b].astype(np.float64)
    state = value.argmax(1)
    best[b] = state
    for step in range(1, int(size[0])):
        m = longer[step]
        at, value = b[:m] + step, value[:m]
        top = (value[rows[:m], best[at - 1]] - switch)[:, None]
        came[at] = value < top
        np.maximum(value, top, out=value)
        value += scores[at]
        now = value.argmax(1)
        best[at] = state[:m] = now
    for step in range(int(size[0]) - 1, -1, -1):
        m = longer[step]
        at = b[:m] + step
        labels[at] = state[:m]
        if step:
            back = came[at, state[:m]]
            if back.any():
                state[:m] = np.where(back, best[at - 1], state[:m])
    return labels


def label_texts(texts: list[str | None], model: Model | None) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
    """(language, score, spans in code points) of each text."""
    out = [(UND, 0.0, []) for _ in texts]
    if model is None:
        return out
    have = [i for i, t in enumerate(texts) if t]
    scores, letters, text_of, first, final = [], [], [], [], []
    offset = np.zeros(len(texts) + 1, np.int64)  # characters of a text already worked on
    for who, part in _blocks([texts[i] for i in have], max(1 << 12, BLOCK_CHARS // max(1, len(model.langs) // 8))):
        words = find_words(part)
        piece = words.text_of()
        ids = np.array([have[i] for i in who], np.int64)
        base = np.array([offset[i] for i in ids])
        begin = np.r_[0, words.ends[:-1]]
        scores.append(model.emissions(words))
        letters.append(words.letters)
        text_of.append(ids[piece])
        first.append(words.start - begin[piece] + base[piece])
        final.append(words.end - begin[piece] + base[piece])
        for i, t in zip(ids, part):
            offset[i] += len(t)
    if not sum(map(len, scores)):
        return out
    scores, letters, text_of = np.concatenate(scores), np.concatenate(letters), np.concatenate(text_of)
    first, final = np.concatenate(first), np.concatenate(final)
    bounds = np.searchsorted(text_of, np.arange(len(texts) + 1))
    labels = viterbi(scores, bounds[:-1], bounds[1:])
    k = len(model.langs)
    share = np.bincount(text_of * k + labels, weights=letters, minlength=len(texts) * k).reshape(-1, k)
    lang = share.argmax(1)
    own = labels == lang[text_of]
    log = np.stack([np.bincount(text_of, np.where(own, scores[:, j], 0), len(texts)) for j in range(k)], 1)
    log -= log.max(1, keepdims=True)
    sure = 1 / np.exp(log).sum(1) * np.exp(log[np.arange(len(texts)), lang])
    opens = np.flatnonzero(np.r_[True, (text_of[1:] != text_of[:-1]) | (labels[1:] != labels[:-1])])
    closes = np.r_[opens[1:], len(labels)] - 1
    for o, c in zip(opens.tolist(), closes.tolist()):
        out[text_of[o]][2].append((int(first[o]), int(final[c]), model.langs[labels[o]]))
    total = share.sum(1)
    for i in np.flatnonzero(bounds[1:] > bounds[:-1]).tolist():
        out[i] = (model.langs[lang[i]], float(share[i, lang[i]] / total[i] * sure[i]), out[i][2])
    return out


def label_documents(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, spans) of every row."""
    spark = shipped(docs).sparkSession
    sent = spark.sparkContext.broadcast(model)  # at most TABLE floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
            cuts = np.flatnonzero(np.diff(size // PASS_BYTES, prepend=-1))  # about so many bytes of texts at once
            for at, end in zip(cuts.tolist(), [*cuts[1:].tolist(), batch.num_rows]):
                part = batch.slice(at, end - at)
                done = label_texts(part.column(1).to_pylist(), sent.value)
                spans = pa.array([[{"start": a, "end": b, "lang": n} for a, b, n in d[2]] for d in done], _SPAN)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.float64()), spans],
                    ["doc_id", "lang_pred", "score", "spans"])

    two = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return two.mapInArrow(run, f"doc_id bigint, {OUT_SCHEMA}")


def identify(docs: DataFrame, **columns) -> DataFrame:
    """Learn from ``docs`` and label its rows: (doc_id, lang_pred, score, spans)."""
    named = {k: v for k, v in columns.items() if k != "lang_col"}
    return label_documents(docs, learn(docs, **columns), **named)
