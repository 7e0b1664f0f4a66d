"""Decontamination, SimHash, token output, mixing and PII against brute force: whole small tables, and a fixture
of nulls, empty and very long texts, ties, repeated rows, clashing extra columns and empty tables."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from llm_helpers import SF, rows_of
from orderpulse.llm import decontam, mixing, pii, simhash, tokens
from orderpulse.llm.common import connected_components, read_table
from orderpulse.llm.queries import END_ID, QUERIES, tokenizer_path

DOC_SCHEMA = "doc_id bigint, text string, source string, h string, row int, target string, fp string, n bigint, ids string"
PASSAGE = "One two three four five six seven eight nine ten eleven twelve"


def make_docs():
    rng = random.Random(5)
    words = [f"w{i}é" if i % 5 == 0 else f"word{i}" for i in range(400)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long, base = text(30_000), text(300)
    near = base.replace(" word1 ", " changed ", 1)
    texts = [None, "", " \n\t ", "one", "one two", base, base, near, base + ".", long, PASSAGE, "x" * 50_000,
             f"{text(40)} {PASSAGE.upper()}! {text(20)}", "Zero 1 two", "  spaced   out\ttext \n\n end ", "<|endoftext|> a . b , c",
             "mail a.b@c.de, b@c.d.e@f.g x@y ip 10.0.0.256 1.2.3.4.5.6.7.8 card 4111 1111 1111 1111 tel +49 (170) 123-4567 +1"]
    texts += [text(rng.randint(1, 80)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(6, base), (None, "no id"), (None, "no id"), (3, "same id, other text")]
    return [(i, t, [None, "a", "b", "ü", "a"][k % 5], "h", 1, "t", "fp", 2, "ids") for k, (i, t) in enumerate(rows)]


DOCS = make_docs()
PAIRS = [(r[0], r[1]) for r in DOCS]
ITEMS = [(1, PASSAGE), (2, "three four five six seven eight nine ten eleven twelve thirteen"), (3, None), (4, ""), (5, "zero 1"),
         (6, "not there at all"), (10, PASSAGE), (7, "ONE")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, DOC_SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


def table(spark, name, *cols):
    return [tuple(r) for r in read_table(spark, SF, name, *cols).collect()]


# --- decontamination -----------------------------------------------------------------

HIT = ("doc_id", "n_words", "n_hit")


def test_decontamination_of_the_table(spark):
    want = brute.decontaminated(table(spark, "documents", "doc_id", "text"), table(spark, "benchmark", "item_id", "text"))
    got = rows_of(QUERIES["op3_decontaminate"](spark, SF), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == sorted(want, key=repr)
    assert any(r[5] for r in want)


@pytest.mark.parametrize("chunk, block", [(200_000, 1 << 20), (3, 50)])
def test_decontamination_cases(spark, docs, items, chunk, block):
    """Also with test windows in many passes and blocks of a few documents."""
    index = decontam.positional_index(docs, block_words=block)
    got = decontam.search(index, items, chunk=chunk)
    want = brute.decontaminated(PAIRS, ITEMS)
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    assert rows_of(got, *HIT, F.size("items"), F.sha2(names, 256)) == sorted((r[:5] for r in want), key=repr)


def test_decontaminated_rows_go_and_others_stay(spark, docs, items):
    clean = decontam.decontaminate(docs, items)
    assert clean.columns == docs.columns
    want = [r for r, hit in zip(DOCS, brute.decontaminated(PAIRS, ITEMS)) if not hit[5]]
    assert rows_of(clean, *clean.columns) == sorted(want, key=repr)


def test_decontamination_of_empty_tables(spark, docs, items):
    assert decontam.search(decontam.positional_index(docs.limit(0)), items).count() == 0
    got = decontam.search(decontam.positional_index(docs), items.limit(0))
    assert got.count() == len(DOCS) and got.where("n_hit > 0").count() == 0


def test_proximity(spark):
    rows = spark.createDataFrame([(1, "alpha x x beta"), (2, "alpha x x x x beta"), (3, "beta"), (4, "alpha"), (5, "beta alpha")],
                                 "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "alpha beta")], "item_id bigint, text string")
    got = decontam.search(decontam.positional_index(rows), items, within=3)
    assert rows_of(got.where("n_hit > 0"), "doc_id") == [(1,), (5,)]


# --- SimHash ---------------------------------------------------------------------------

def test_simhash_of_the_table(spark):
    want = brute.simhash_groups(table(spark, "documents", "doc_id", "text"))
    assert rows_of(QUERIES["op6_simhash"](spark, SF), "doc_id", "fingerprint", "component_id") == sorted(want, key=repr)


def test_simhash_cases(spark, docs):
    got = simhash.near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("f"), "component_id")
    assert rows_of(got, "doc_id", "f", "component_id") == sorted(brute.simhash_groups(PAIRS), key=repr)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_one_row_of_each_group_stays(spark, docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    groups = {}
    for row, root in zip(PAIRS, brute.simhash_roots([brute.simhash(t) for _, t in PAIRS])):
        groups.setdefault(root, []).append(row)
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == len(groups)
    for members in groups.values():
        (one,) = [m for m in set(members) if m in got]
        assert one[0] == min((d for d, _ in members if d is not None), default=None)


def test_links_of_dense_groups_join_what_all_pairs_join():
    import numpy as np

    rng = np.random.default_rng(1)
    x = set(rng.integers(0, 2**63, 300, dtype=np.uint64).tolist())
    for center in list(x)[:3]:  # balls of many fingerprints, some beyond the threshold
        for _ in range(400):
            y = center
            for b in rng.integers(0, 64, rng.integers(1, 5)):
                y ^= 1 << int(b)
            x.add(y)
    x = np.array(sorted(x), np.uint64)
    code = simhash.HammingAnchors()
    who, anchor = code.visits(x)
    assert len(who) == 156 * len(x)
    home = anchor == code.home(x)[who]
    assert home.sum() == len(x)
    order = np.argsort(anchor, kind="stable")
    g, brute_g, at = brute.Groups(len(x)), brute.Groups(len(x)), {int(v): i for i, v in enumerate(x)}
    n = 0
    for a, b in simhash._forest_in_anchors(anchor[order], x[who][order], home[order], 2):
        for p, q in zip(a.tolist(), b.tolist()):
            assert (p ^ q).bit_count() <= 2
            g.join(at[p], at[q])
            n += 1
    for i, j in np.argwhere(np.bitwise_count(x[:, None] ^ x[None, :]) <= 2):
        brute_g.join(i, j)
    assert [g.find(i) for i in range(len(x))] == [brute_g.find(i) for i in range(len(x))]


def test_both_codes_link_the_same(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    x = np.unique(np.concatenate([base] + [base ^ (np.uint64(1) << rng.integers(0, 64, 60, dtype=np.uint64)) for _ in range(4)]))
    df = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp bigint")
    roots = [sorted(tuple(r) for r in connected_components(simhash.anchor_links(df, r=r), "a", "b").collect()) for r in (5, 6)]
    assert roots[0] == roots[1] and len(roots[0]) > 200
    assert simhash.copies_of(2, 5) == 156 and simhash.copies_of(2, 6) == 652
    assert [simhash.code_bits(n) for n in (0, 10**8, 10**9)] == [5, 5, 6]


# --- token output ------------------------------------------------------------------------

def test_tokens_of_the_table(spark):
    want = brute.tokens(table(spark, "documents", "doc_id", "text"), tokenizer_path(), END_ID)
    assert rows_of(QUERIES["op7_token_output"](spark, SF), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)


@pytest.mark.parametrize("vocab", [1 << 16, 1 << 17])
def test_token_cases(spark, docs, vocab, monkeypatch):
    monkeypatch.setattr(tokens, "DOCS_PER_SHARD", 16)
    monkeypatch.setattr(tokens, "KEYS_PER_BUCKET", 8)
    files, index, found = tokens.token_output(docs, tokenizer_path(), END_ID, vocab_size=vocab)
    got = [tuple(r) for r in found.select("doc_id", "n_tokens", "ids_crc32").collect()]
    want = brute.tokens(PAIRS, tokenizer_path(), END_ID)
    assert sorted(got, key=repr) == sorted(((d, n, c) for d, _, n, c in want), key=repr)
    # rows of one id may stand in either order; each start is the sum of all before it
    at = 0
    for r in sorted(found.collect(), key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(found.collect(), key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    got = tokens.ids_of(spark, files, index, -(-len(DOCS) // 8), [(5, 0), (123456, 0), (5, 1)])
    assert zlib.crc32(b"".join(i.to_bytes(4, "little") for i in got[5, 0])) == dict((d, c) for d, _, _, c in want)[5]
    assert (123456, 0) not in got and (5, 1) not in got


def test_a_repeated_id_is_spread_over_the_index(spark, monkeypatch):
    monkeypatch.setattr(tokens, "KEYS_PER_BUCKET", 8)
    monkeypatch.setattr(tokens, "KEYS_PER_CHUNK", 16)
    monkeypatch.setattr(tokens, "DOCS_PER_SHARD", 64)
    rows = [(7, f"copy {i % 11}") for i in range(200)] + [(None, None)] * 50 + [(i, f"text {i}") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    files, index, found = tokens.token_output(df, tokenizer_path(), END_ID)
    got = found.collect()
    want = brute.tokens(rows, tokenizer_path(), END_ID)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=repr) == sorted(((d, n, c) for d, _, n, c in want), key=repr)
    assert sorted(r.occurrence for r in got if r.doc_id == 7) == list(range(201))
    assert sorted(r.occurrence for r in got if r.doc_id is None) == list(range(50))
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    # occurrences are numbered in file order, and no bucket holds more than a few times its share
    starts = [r.start for r in sorted(got, key=lambda r: r.occurrence) if r.doc_id == 7]
    assert starts == sorted(starts)
    assert max(r.n_slots for r in index.select("n_slots").collect()) <= 24


def test_tokens_of_an_empty_table(spark, docs):
    files, index, found = tokens.token_output(docs.limit(0), tokenizer_path(), END_ID)
    assert files.count() == index.count() == found.count() == 0


def test_pieces_are_the_whole_text():
    """The encoder that remembers words gives what the tokenizer gives for the whole text."""
    enc = tokens.PieceEncoder(tokenizer_path(), 4)
    rng = random.Random(2)
    parts = ["foo", " ", "  ", "\n", "\n\n", ".", ",", ". ", ", ", "!,", " a", "É", "12", "\t", "'s", " <|endoftext|>", "..", "). ",
             "_. ", "x\n", " ", "é,", "\x01", "\x00", "日本", "👍", "é. "]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        want = enc.tokenizer.encode(text, add_special_tokens=False).ids
        assert enc.encode(text) == b"".join(i.to_bytes(4, "little") for i in want), text


def test_minimal_perfect_hash():
    import numpy as np

    for n in [*range(1, 200), 500, 4096]:
        h = tokens._key_hash(np.arange(n), np.zeros(n, int))
        pilots = tokens.build_mph(h)
        assert sorted(tokens.mph_slots(h, pilots, n).tolist()) == list(range(n))


# --- mixing -----------------------------------------------------------------------------

def check_mix(rows, mixed):
    """rows: [(doc_id, source, size)]; mixed: [(doc_id, source, size, source_size, target, copies)]."""
    sizes = {}
    for _, source, size in rows:
        sizes[source] = sizes.get(source, 0) + size
    want = brute.targets(sizes)
    assert sorted((r[:3] for r in mixed), key=repr) == sorted(rows, key=repr)
    for _, source, size, source_size, target, copies in mixed:
        assert source_size == sizes[source] and target == pytest.approx(want[source], rel=1e-12)
        rate = target / source_size if source_size else 0
        assert int(rate) <= copies <= min(3, int(rate) + 1)
    for source in sizes:
        n = sum(1 for r in rows if r[1] == source)
        copies = sum(r[5] for r in mixed if r[1] == source)
        expected = n * want[source] / sizes[source] if sizes[source] else 0
        assert abs(copies - expected) <= 1  # systematic: the copies are the expected number, up or down


def mixed_rows(df):
    return [tuple(r) for r in mixing.mix(df).select("doc_id", "source", "_size", "_source_size", "_target", "_copies").collect()]


def test_mix_of_the_table(spark):
    rows = [(d, s, len(brute.SPACED.findall(t or ""))) for d, s, t in table(spark, "documents", "doc_id", "source", "text")]
    check_mix(rows, mixed_rows(read_table(spark, SF, "documents")))


def test_mix_cases(spark, docs):
    rows = [(r[0], r[2], len(brute.SPACED.findall(r[1] or ""))) for r in DOCS]
    got = mixed_rows(docs)
    check_mix(rows, got)
    assert sorted(got, key=repr) == sorted(mixed_rows(docs.repartition(7)), key=repr)
    assert mixed_rows(docs.limit(0)) == []
    blank = docs.withColumn("text", F.lit(None).cast("string"))
    assert all(r[5] == 0 for r in mixed_rows(blank))


def test_mix_emits_copies_with_the_documents_columns(spark, docs):
    out = mixing.emit(mixing.mix(docs))
    assert out.columns == docs.columns
    assert out.count() == sum(r[5] for r in mixed_rows(docs))


CLASHING = ["_size", "_target", "_Copies", "_source_size", "_copy", "_salt", "_key", "_row", "__key", "_id", "_h"]


def test_columns_of_such_names_stay(spark, docs, items):
    more = docs.select("*", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in CLASHING])
    for got, plain in [(mixing.emit(mixing.mix(more)), mixing.emit(mixing.mix(docs))),
                       (decontam.decontaminate(more, items), decontam.decontaminate(docs, items)),
                       (simhash.keep_one(more), simhash.keep_one(docs))]:
        assert got.columns == more.columns
        assert rows_of(got, "doc_id", "text") == rows_of(plain, "doc_id", "text")
        assert all(r[n] == (None if r.doc_id is None else f"{n}{r.doc_id}") for r in got.collect() for n in CLASHING)
    assert mixing.mix(more).columns[-4:] == ["__size", "__source_size", "__target", "__copies"]


def test_mix_plan_has_no_python(spark, docs):
    plan = mixing.emit(mixing.mix(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


# --- personal data ---------------------------------------------------------------------------

def pii_rows(df):
    return rows_of(pii.personal_data(df), "doc_id", pii.joined("base"))


def test_pii_of_the_table(spark):
    want = [(d, ",".join(brute.pii_base(t))) for d, t in table(spark, "documents", "doc_id", "text")]
    assert pii_rows(read_table(spark, SF, "documents")) == sorted(want, key=repr)
    assert any(w for _, w in want)


def test_pii_cases(spark, docs):
    assert pii_rows(docs) == sorted(((d, ",".join(brute.pii_base(t))) for d, t in PAIRS), key=repr)
    assert pii.personal_data(docs.limit(0)).count() == 0


def test_pii_random_texts(spark):
    rng = random.Random(3)
    parts = list("0123456789..+- ()@ax_%é") + ["1.2.3.4", "255", "256.", "@b.c", "4111111111111111", "+1 (2", "\n", "a@b.cd"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["9" * 20_000, "1 " * 20_000, "a@" * 5_000 + "b.c", "1.2.3.4 " * 3_000, "+1-" + "2" * 9_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert pii_rows(df) == sorted(((d, ",".join(brute.pii_base(t))) for d, t in enumerate(texts)), key=repr)


def test_pii_method_adds_looser_forms_only(spark):
    base = "mail me at jo.doe@example.com or call +1 (988) 555-2485, host 42.144.35.254, card 4111 1111 1111 1111. "
    loose = ["write to jo.doe [at] example [dot] com please", "my phone: (988) 555-2485 after six", "call 988-555-2485",
             "server 10[.]0[.]0[.]1", "visa 4111.1111.1111.1111 today"]
    clean = ["version 1.2.3", "order 988-55-2485", "they met at home dot", "in 1999 and 2001", "figures 12 345 678", "a @ b", "v2 (988)"]
    rows = [(i, base) for i in range(40)] + [(100 + i, t) for i, t in enumerate(loose)] + [(200 + i, t) for i, t in enumerate(clean)]
    got = {r[0]: (r[1], r[2]) for r in rows_of(pii.personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")),
                                               "doc_id", pii.joined("base"), pii.joined("spans"))}
    assert all(b == s and b for i, (b, s) in got.items() if i < 40)
    assert all(s and not b for i, (b, s) in got.items() if 100 <= i < 200)
    assert all(not s for i, (_, s) in got.items() if i >= 200)


def test_pii_plan_has_no_python(spark):
    plan = pii.find(read_table(spark, SF, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_em_finds_reliable_labelers():
    rng = random.Random(1)
    counts = {}
    for _ in range(4000):
        truth = rng.random() < 0.6
        good = lambda p: 1 if (rng.random() < p) == truth else -1
        votes = (1 if truth and rng.random() < 0.7 else 0, good(0.6), good(0.9), good(0.95), -1 if not truth and rng.random() < 0.5 else 0)
        counts[votes] = counts.get(votes, 0) + 1
    patterns = [(0, v, c) for v, c in counts.items()]
    post = pii.reliabilities(patterns)
    assert post[0, (1, 1, 1, 1, 0)] > 0.95 and post[0, (0, 1, -1, -1, -1)] < 0.05
    w = pii.train(patterns)
    assert w[3] > w[1] > -0.5 and w[2] > w[1]


def test_pii_learns_from_what_fails_its_check(spark):
    """On the given tables, where every looser form and most votes agree, no labeler counts against itself."""
    found = pii.find(read_table(spark, "/root/testdata/sf0.1", "documents"))
    patterns = pii.vote_patterns(found)
    w = pii.train(patterns)
    assert all(x > 0 for x in w[:4]) and {v[0] for _, v, _ in patterns} >= {1, -1}
    post = pii.reliabilities(patterns)
    assert all(p > 0.5 for (k, v), p in post.items() if v[0] == 1 and v[3] == 1 and v[4] == 0)
    assert all(p < 0.5 for (k, v), p in post.items() if v[0] == -1 and v[3] == -1)


def test_pii_many_matches_in_one_text(spark):
    text = "in 1999, 2001 or 12 345; " * 20_000
    df = spark.createDataFrame([(1, text + "mail a@b.cd")], "doc_id bigint, text string")
    (got,) = rows_of(pii.personal_data(df), "doc_id", pii.joined("base"))
    assert got == (1, f"email:{len(text) + 5}:{len(text) + 11}")
