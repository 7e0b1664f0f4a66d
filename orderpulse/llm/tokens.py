"""Token-ID / binary output with keyed access through a minimal perfect hash index.

Files: Parquet rows of at most about ``chunk_bytes`` of raw little-endian ids (unsigned 16 bit
where the vocabulary allows, else 32 bit), in ascending ``doc_id`` order, each with its documents'
ids and offsets. Index: keys are dealt to hash buckets of a few thousand; each bucket stores a
minimal perfect hash (hash and displace) whose slots hold a key fingerprint and the place of the
payload (shard, chunk, offset, length), so a key is found in constant time and a foreign key is
refused by its fingerprint.

Defined cases: a null or empty text is the end id alone; repeated ids (ties) keep every row, ordered
by their ids and told apart by an occurrence number (0, 1, ...) in the key; a null ``doc_id``
comes first; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderpulse.llm.common import arrow_rows, shipped, stored

DOCS_PER_SHARD = 4096
MAX_SHARDS = 20_000          # shard bounds are the only thing kept on the driver
CHUNK_BYTES = 1 << 18
KEYS_PER_CHUNK = 8192
KEYS_PER_BUCKET = 4096
KNOWN_WORDS = 400_000        # words a worker remembers; beyond it the memory starts afresh
KNOWN_TAILS = 10_000         # strings of marks, likewise
FILE_SCHEMA = ("shard int, chunk int, width int, keys array<bigint>, offsets array<bigint>, "
               "n_tokens bigint, payload binary")
INDEX_SCHEMA = ("bucket bigint, n_slots int, pilots binary, fingerprints binary, shards binary, "
                "chunks binary, offsets binary, lengths binary")
_SLOT = {"shards": "<i4", "chunks": "<i4", "offsets": "<i8", "lengths": "<i8"}
_ENCODERS: dict = {}


class PieceEncoder:
    """Whole-text encoding that remembers the ids of words met more than once.

    A byte-level BPE of this kind joins no text across the space before a word nor across one line
    end, and no letter or digit with a mark after it. So a text whose only white space is single
    spaces and single line ends is the concatenation of its pieces (line ends, words with the space
    before them, full stops and commas before white space), each encoded by the tokenizer. Any other
    text is encoded whole, as is one without a letter or digit before such a full stop or comma.
    """

    def __init__(self, path: str, width: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.code = "H" if width == 2 else "I"
        self.packs = [struct.Struct(f"<{n}{self.code}").pack for n in range(64)]
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        rest = sorted(set(range(256)) - set(shown))
        #: the printable stand-ins of byte-level vocabularies: other bytes are numbered from 256
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.marks = {m: self._whole(m) for m in ("\n", ",", ".")}
        self.met = bytearray(1 << 22)  # one byte a hash value: whether such a word was met
        self._start()

    def _start(self) -> None:
        #: ids of a word with the space before it; of a line's first word under its name after "\3"
        self.known: dict[str, bytes] = {"\1": self.marks[","], "\2": self.marks["."], "\4": self.marks["\n"]}
        self.marked: set[str] = set()  # known words that end in a mark
        self.tails: dict[str, bytes] = {}

    def _raw(self, ids: list[int]) -> bytes:
        return self.packs[len(ids)](*ids) if len(ids) < 64 else struct.pack(f"<{len(ids)}{self.code}", *ids)

    def _whole(self, text: str) -> bytes:
        return self._raw(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, before: str, word: str) -> bytes:
        told = word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode("utf-8")))
        return self._raw([t.id for t in self.tokenize(before + told)])

    def _with_marks(self, w: str) -> bytes:
        """Ids of a word of the memory's kind that is not letters alone; of one with marks after it, those of the
        word (often known) and those of the marks (few kinds)."""
        text, stem = w[1:] if w[:1] == "\3" else " " + w, w.rstrip(_TAIL)
        if stem == w or not stem[-1:].isalnum():
            return self.piece(text)
        tail = w[len(stem):]
        if tail not in self.tails:
            if len(self.tails) > KNOWN_TAILS:
                self.tails.clear()
            self.tails[tail] = self._whole(tail)
        return (self.known.get(stem) or self.piece(text[:-len(tail)])) + self.tails[tail]

    def piece(self, text: str) -> bytes:
        """Ids of a piece."""
        space = text[:1] == " "
        word = text[1:] if space else text
        if word.isalpha():  # one word: one step of the model
            return self._word(self.letters[32] if space else "", word)
        word = text.rstrip(_TAIL)
        if word != text and word[-1:].isalnum():
            return self.piece(word) + self._whole(text[len(word):])
        return self._whole(text)

    def encode(self, text: str) -> bytes:
        if text[:2] in (". ", ", ") or any(s in text for s in _JOINED) or not text.isascii() and any(s in text for s in _JOINED_WIDE):
            return self._whole(text)
        if len(self.known) > KNOWN_WORDS:
            self._start()
        known, met = self.known, self.met
        last = text[-1:] if text[-1:] in (".", ",") and text[-2:-1].isalnum() else ""
        body = (text[:-1] if last else text).replace(", ", " \1 ").replace(". ", " \2 ")
        if "\n" in body:
            body = body.replace(",\n", " \1\n").replace(".\n", " \2\n").replace("\n", " \4 \3")
        words = ("\3" + body).split(" ")
        once, marked, kinds, space = [], False, set(words), self.letters[32]
        for w in kinds.difference(known):
            if w.isalpha():
                known[w], ends = self._word(space, w), False
            else:
                known[w], ends = self._with_marks(w), not w[-1:].isalnum() and w != "\3"
            at = hash(w) & 0x3FFFFF
            if met[at]:
                if ends:
                    self.marked.add(w)
            else:
                met[at] = 1
                once.append(w)
                marked = marked or ends
        out = list(map(known.__getitem__, words))
        if last:
            out.append(self.marks[last])
        marked = marked or not self.marked.isdisjoint(kinds)
        for w in once:  # kept from their second text on
            del known[w]
        return self._whole(text) if marked and _MARKED.search(text) else b"".join(out)


#: Marks after a word; an apostrophe may belong to it, and < and | to a special token.
_TAIL = ".,;:!?*#$%&)"
_MARKED = re.compile(r"(?:[^\w\s]|_)[.,][ \n]")
#: White space that may share a token with its neighbours, and the stand-ins of marks.
_JOINED = ("  ", "\n ", " \n", "\n\n", " . ", " , ", "\n. ", "\n, ", " .\n", " ,\n", "., ", ",. ", *"\0\1\2\3\4\t\v\f\r\x1c\x1d\x1e\x1f")
_JOINED_WIDE = tuple("\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
                     "\u2028\u2029\u202f\u205f\u3000")


def _encoder(path: str, width: int) -> PieceEncoder:
    if (path, width) not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        _ENCODERS[path, width] = PieceEncoder(path, width)
    return _ENCODERS[path, width]


def _forget() -> None:
    """Called by the stages after the encoding: a worker that did some of it lets its memory go."""
    _ENCODERS.clear()


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int, width: int = 2, bounds: list[int] | None = None,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(shard, doc_id, ids): raw ids of every whole text with the end id; ``bounds`` deal the
    document ids to shards."""
    cuts = np.array(bounds or [], dtype=np.int64)
    end = np.array([end_id], "<u2" if width == 2 else "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(tokenizer, width)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [enc.encode(t or "") + end for t in part.column(1).to_pylist()]
                keys = part.column(0).to_pylist()
                shard = np.searchsorted(cuts, np.array([-2**63 if k is None else k for k in keys], np.int64), "right")
                yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(keys, pa.int64()),
                                                  pa.array(ids, pa.binary())], ["shard", "doc_id", "ids"])

    two = shipped(docs).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return two.mapInArrow(run, "shard int, doc_id bigint, ids binary")


def shard_bounds(docs: DataFrame, id_col: str = "doc_id", docs_per_shard: int = DOCS_PER_SHARD) -> list[int]:
    n = docs.count()
    k = min(MAX_SHARDS, -(-n // docs_per_shard))
    if k <= 1:
        return []
    got = docs.agg(F.percentile_approx(F.col(id_col).cast("bigint"), [i / k for i in range(1, k)])).first()[0]
    return sorted(set(got or []))


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, vocab_size: int = 1 << 16,
                      id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Encode ``docs`` and write the token files; returns the files, read back."""
    width = 2 if vocab_size <= 1 << 16 else 4
    ids = encode_documents(docs, tokenizer, end_id, width, shard_bounds(docs, id_col), id_col, text_col)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget()
        shard, chunk, keys, parts, size = None, 0, [], [], 0

        def row() -> pa.RecordBatch:
            offsets = np.cumsum([0] + [len(p) // width for p in parts])
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([chunk], pa.int32()), pa.array([width], pa.int32()),
                 pa.array([keys], pa.list_(pa.int64())), pa.array([offsets[:-1]], pa.list_(pa.int64())),
                 pa.array([int(offsets[-1])], pa.int64()), pa.array([b"".join(parts)], pa.binary())],
                ["shard", "chunk", "width", "keys", "offsets", "n_tokens", "payload"])

        for batch in batches:
            for s, key, part in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if s != shard or size >= chunk_bytes or len(keys) >= KEYS_PER_CHUNK:
                    if parts:
                        yield row()
                    chunk, shard, keys, parts, size = (chunk + 1 if s == shard else 0), s, [], [], 0
                keys.append(key)
                parts.append(part)
                size += len(part)
        if parts:
            yield row()

    ordered = ids.repartition("shard").sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "ids")
    with arrow_rows(docs.sparkSession, 1000):
        return stored(ordered.mapInArrow(pack, FILE_SCHEMA), "token-files")


# --- minimal perfect hash ----------------------------------------------------------

def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """SplitMix64 finaliser."""
    with np.errstate(over="ignore"):
        z = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def _key_hash(keys, occurrence, no_id=None) -> np.ndarray:
    """64-bit hashes of (id, occurrence); a null id hashes as a value of its own."""
    ids = np.ascontiguousarray(keys, np.int64).view(np.uint64)
    null = np.zeros(len(ids), bool) if no_id is None else np.asarray(no_id, bool)
    occ = np.asarray(occurrence, np.int64).view(np.uint64)
    return _mix(_mix(ids, 1) ^ _mix(occ, 2) ^ np.where(null, np.uint64(0xA5A5A5A5), np.uint64(0)), 3)


def build_mph(h: np.ndarray) -> np.ndarray:
    """Pilots of a minimal perfect hash of distinct 64-bit hashes: groups of about four keys, the
    largest first, take the first displacement that sends them to free slots; a group of one
    key stores its slot itself, as -(slot + 1)."""
    n = len(h)
    r = max(1, n // 4)
    group = (_mix(h, 11) % np.uint64(r)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    starts = np.searchsorted(group[order], np.arange(r + 1))
    sizes = np.diff(starts)
    pilots, free = np.zeros(r, np.int64), np.ones(n, bool)
    for g in np.argsort(-sizes, kind="stable"):
        members = order[starts[g]:starts[g + 1]]
        if len(members) < 2:
            break
        d = 0
        while True:
            slots = _slots(h[members][None, :], np.arange(d, d + 256, dtype=np.uint64)[:, None], n)
            fits = free[slots].all(1)
            fits[fits] = (np.diff(np.sort(slots[fits], 1), axis=1) > 0).all(1)
            if fits.any():
                k = int(np.argmax(fits))
                pilots[g], d = d + k, -1
                free[slots[k]] = False
                break
            d += 256
    rest = np.flatnonzero(free)
    for slot, g in zip(rest, np.flatnonzero(sizes == 1)):
        pilots[g] = -(int(slot) + 1)
    return pilots


def _slots(h, d, n: int) -> np.ndarray:
    """Slots under displacement ``d``: from all 64 bits, so distinct hashes part under some d."""
    return (_mix(h ^ _mix(d, 12), 13) % np.uint64(n)).astype(np.int64)


def mph_slots(h: np.ndarray, pilots: np.ndarray, n: int) -> np.ndarray:
    """Slot of each hash; of a key that was not indexed, any slot."""
    p = pilots[(_mix(h, 11) % np.uint64(len(pilots))).astype(np.int64)]
    return np.where(p < 0, -p - 1, _slots(h, np.maximum(p, 0).astype(np.uint64), n))


def fingerprint(h: np.ndarray) -> np.ndarray:
    return (_mix(h, 21) >> np.uint64(32)).astype("<u4")


def _bucket(buckets: int):
    """Of a key, its occurrence included: the rows of a repeated id are spread over all buckets."""
    return F.pmod(F.xxhash64("doc_id", "occurrence"), F.lit(buckets)).alias("bucket")


def _carried(files: DataFrame) -> DataFrame:
    """(shard, chunk, before): of the chunks whose first id has rows in chunks before, how many. Files are in the
    order of the ids, so such an id is the last of the chunk before, and no other id of a chunk has rows elsewhere."""
    def ends(at: int):
        key = F.element_at("keys", at)
        return F.struct(key.alias("doc_id"), F.size(F.filter("keys", lambda k: k.eqNullSafe(key))).alias("n"),
                        F.lit(at == 1).alias("first"))

    one = F.element_at("keys", 1).eqNullSafe(F.element_at("keys", -1))
    runs = files.select("shard", "chunk", F.explode(F.when(one, F.array(ends(1))).otherwise(F.array(ends(1), ends(-1)))).alias("r"))
    so_far = W.partitionBy("shard", "r.doc_id").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    return (runs.withColumn("before", F.sum("r.n").over(so_far)).where("r.first and before > 0")
            .select("shard", "chunk", "before"))


def places_of(files: DataFrame) -> DataFrame:
    """(doc_id, no_id, occurrence, shard, chunk, at, n) of every row of the files; occurrences of an id are numbered
    in file order. A null id is 0 with ``no_id``: pandas would turn whole numbers with nulls into floats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget()
        for batch in batches:
            for i in range(batch.num_rows):
                keys, at = batch.column(2)[i].values, batch.column(3)[i].values.to_numpy()
                no_id, ids = keys.is_null().to_numpy(zero_copy_only=False), keys.fill_null(0).to_numpy()
                place = np.arange(len(ids))
                starts = np.r_[True, (ids[1:] != ids[:-1]) | (no_id[1:] != no_id[:-1])]
                occurrence = place - np.maximum.accumulate(np.where(starts, place, 0))
                occurrence[np.cumsum(starts) == 1] += batch.column(5)[i].as_py() or 0
                n = np.diff(np.r_[at, batch.column(4)[i].as_py()])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(no_id), pa.array(occurrence), pa.array(np.full(len(ids), batch.column(0)[i].as_py(), np.int32)),
                     pa.array(np.full(len(ids), batch.column(1)[i].as_py(), np.int32)), pa.array(at), pa.array(n)],
                    ["doc_id", "no_id", "occurrence", "shard", "chunk", "at", "n"])

    chunks = files.select("shard", "chunk", "keys", "offsets", "n_tokens").join(_carried(files), ["shard", "chunk"], "left")
    return shipped(chunks).select("shard", "chunk", "keys", "offsets", "n_tokens", "before").mapInArrow(
        run, "doc_id bigint, no_id boolean, occurrence bigint, shard int, chunk int, at bigint, n bigint")


def build_index(files: DataFrame, buckets: int) -> DataFrame:
    """One row per hash bucket of keys (id, occurrence), stored; see ``locate``."""
    places = places_of(files).withColumn("bucket", _bucket(buckets))

    def build(key, pdf):
        _forget()
        pdf = pdf.sort_values(["no_id", "doc_id", "occurrence"])
        h = _key_hash(pdf["doc_id"].to_numpy(), pdf["occurrence"].to_numpy(), pdf["no_id"].to_numpy())
        pilots = build_mph(h)
        to = np.argsort(mph_slots(h, pilots, len(h)))
        cols = {name: pdf[c].to_numpy()[to].astype(t).tobytes()
                for (name, t), c in zip(_SLOT.items(), ("shard", "chunk", "at", "n"))}
        import pandas as pd

        return pd.DataFrame([{"bucket": key[0], "n_slots": len(h), "pilots": pilots.astype("<i8").tobytes(),
                              "fingerprints": fingerprint(h[to]).tobytes(), **cols}])

    with arrow_rows(files.sparkSession, 256):
        return stored(places.groupBy("bucket").applyInPandas(build, INDEX_SCHEMA), "token-index")


def locate(index: DataFrame, keys: DataFrame, buckets: int) -> DataFrame:
    """(doc_id, occurrence, shard, chunk, at, n) of the keys that the index holds."""
    schema = "doc_id bigint, occurrence bigint, shard int, chunk int, at bigint, n bigint"

    def find(left, right):
        import pandas as pd

        if right.empty or left.empty:
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("doc_id", "occurrence", "shard", "chunk", "at", "n")})
        row = right.iloc[0]
        h = _key_hash(left["doc_id"].to_numpy(), left["occurrence"].to_numpy(), left["no_id"].to_numpy())
        slot = mph_slots(h, np.frombuffer(row.pilots, "<i8"), int(row.n_slots))
        known = np.frombuffer(row.fingerprints, "<u4")[slot] == fingerprint(h)
        out = {"doc_id": left["doc_id"].astype("Int64").mask(left["no_id"]), "occurrence": left["occurrence"]}
        out |= {to: np.frombuffer(row[c], t)[slot] for (c, t), to in zip(_SLOT.items(), ("shard", "chunk", "at", "n"))}
        return pd.DataFrame(out)[known]

    keyed = shipped(keys).select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "occurrence",
                                 F.col("doc_id").isNull().alias("no_id")).withColumn("bucket", _bucket(buckets))
    return keyed.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(find, schema)


def read_payloads(files: DataFrame) -> DataFrame:
    """(shard, chunk, at, n, ids_crc32): every document's ids read back from the raw payload."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget()
        for batch in batches:
            for r in batch.to_pylist():
                ids = np.frombuffer(r["payload"], "<u2" if r["width"] == 2 else "<u4")
                cuts = [*r["offsets"], len(ids)]
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(cuts, cuts[1:])]
                k = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["shard"]] * k, pa.int32()), pa.array([r["chunk"]] * k, pa.int32()),
                     pa.array(cuts[:-1], pa.int64()), pa.array(np.diff(cuts), pa.int64()), pa.array(crc, pa.int64())],
                    ["shard", "chunk", "at", "n", "ids_crc32"])

    rows = shipped(files).select("shard", "chunk", "width", "offsets", "payload").mapInArrow(
        run, "shard int, chunk int, at bigint, n bigint, ids_crc32 bigint")
    with arrow_rows(files.sparkSession, 32):
        return stored(rows, "token-payloads")


def chunk_starts(files: DataFrame) -> DataFrame:
    """(shard, chunk, first): ids in all chunks before: sums of the shards (at most MAX_SHARDS) added up in
    order, and inside a shard those of its chunks."""
    before = lambda w: F.coalesce(F.sum("n_tokens").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    chunks = files.select("shard", "chunk", "n_tokens")
    shards = chunks.groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens"))
    shards = shards.select("shard", before(W.orderBy("shard")).alias("base"))
    inside = before(W.partitionBy("shard").orderBy("chunk"))
    return chunks.select("shard", "chunk", inside.alias("in_shard")).join(shards, "shard").select(
        "shard", "chunk", (F.col("base") + F.col("in_shard")).alias("first"))


def keys_of(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, occurrence) of every row. The occurrences of an id with many rows are made in ranges, by as many tasks."""
    first = F.col("range") * KEYS_PER_BUCKET
    counted = docs.groupBy(F.col(id_col).cast("bigint").alias("doc_id")).count()
    ranges = counted.select("doc_id", "count", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(count - 1) div {KEYS_PER_BUCKET}"))).alias("range"))
    many = F.col("count") > KEYS_PER_BUCKET
    ranges = ranges.where(~many).unionByName(ranges.where(many).repartition("doc_id", "range"))
    return ranges.select("doc_id", F.explode(F.sequence(first, F.least(F.col("count"), first + KEYS_PER_BUCKET) - 1)).alias("occurrence"))


def token_output(docs: DataFrame, tokenizer: str, end_id: int, vocab_size: int = 1 << 16,
                 id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Write files and index for ``docs``, then look every document up: returns (files, index,
    documents found: doc_id, occurrence, start, n_tokens, ids_crc32)."""
    files = write_token_files(docs, tokenizer, end_id, vocab_size, id_col, text_col)
    keys = keys_of(docs, id_col)
    n = files.agg(F.sum(F.size("keys"))).first()[0] or 0
    buckets = max(1, -(-n // KEYS_PER_BUCKET))
    index = build_index(files, buckets)
    found = (locate(index, keys, buckets)
             .join(read_payloads(files), ["shard", "chunk", "at", "n"])
             .join(chunk_starts(files), ["shard", "chunk"])
             .select("doc_id", "occurrence", (F.col("first") + F.col("at")).alias("start"),
                     F.col("n").alias("n_tokens"), "ids_crc32"))
    return files, index, found


def ids_of(spark: SparkSession, files: DataFrame, index: DataFrame, buckets: int, keys: list[tuple]) -> dict:
    """Keyed access for a few (doc_id, occurrence) keys: their ids, or nothing for unknown keys."""
    ask = spark.createDataFrame(keys, "doc_id bigint, occurrence bigint")
    hits = locate(index, ask, buckets).join(files, ["shard", "chunk"])
    wide = F.col("width").cast("long")
    cut = hits.select("doc_id", "occurrence", "width", F.expr(
        "substring(payload, cast(at * width + 1 as int), cast(n * width as int))").alias("ids"), wide.alias("w"))
    return {(r.doc_id, r.occurrence): np.frombuffer(r.ids, "<u2" if r.width == 2 else "<u4").tolist()
            for r in cut.collect()}
