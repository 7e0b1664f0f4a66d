"""Language identification, prefix trie and spelling variants: held-out accuracy, brute force over whole small
tables, and fixtures of nulls, empty and very long texts, ties, repeated rows, clashing columns, empty tables."""

import random

import numpy as np
import pytest

import brute
from llm_helpers import SF, rows_of
from orderpulse.llm import langid, prefixtrie, spelling
from orderpulse.llm.common import read_table
from orderpulse.llm.queries import QUERIES

# --- language identification ------------------------------------------------------------


@pytest.fixture(scope="module")
def model(spark):
    return langid.learn(read_table(spark, "/root/testdata/sf0.01", "documents"))


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = read_table(spark, sf, "documents", "doc_id", "text", "lang")
    got = {r.doc_id: r for r in QUERIES["op11_language"](spark, sf).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    held = [r for r in rows if got[r.doc_id].held_out]
    import zlib
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    right = [got[r.doc_id].lang_pred == r.lang for r in held if r.lang and r.text]
    assert np.mean(right) >= 0.98 and len(right) > 150
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_of_the_held_out_rows_changes_nothing(spark):
    from pyspark.sql import functions as F
    docs = read_table(spark, SF, "documents")
    other = docs.withColumn("lang", F.when(langid.held_out(), F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    one, two = langid.identify(docs), langid.identify(other)
    assert rows_of(one, "doc_id", "lang_pred", "score") == rows_of(two, "doc_id", "lang_pred", "score")


def test_viterbi_finds_the_best_labels():
    rng = np.random.default_rng(4)
    for _ in range(40):
        sizes = rng.integers(0, 7, 5)
        scores = (-rng.exponential(2, (sizes.sum(), 3))).astype(np.float32)
        end = np.cumsum(sizes)
        labels = langid.viterbi(scores, end - sizes, end, switch=1.5)
        for a, b in zip(end - sizes, end):
            if b > a:
                best, total = brute.best_labels(scores[a:b].astype(float).tolist(), 1.5)
                assert total(labels[a:b].tolist()) == pytest.approx(best, abs=1e-5)


def test_mixed_text_has_spans_of_both_languages(spark, model):
    docs = {r.lang: r.text for r in read_table(spark, "/root/testdata/sf0.1", "documents").where("n_chars between 400 and 900")
            .where("doc_id % 7 = 3").collect()}
    text = docs["de"] + "\n" + docs["fr"]
    (lang, score, spans), = langid.label_texts([text], model)
    cut = len(docs["de"])
    at = {s[2]: sum(min(s[1], cut) - s[0] for s in spans if s[2] == k[2] and s[0] < cut) for k in spans for s in spans}
    de = sum(min(b, cut) - a for a, b, name in spans if name == "de" and a < cut)
    fr = sum(b - max(a, cut) for a, b, name in spans if name == "fr" and b > cut)
    assert de > 0.8 * cut and fr > 0.8 * len(docs["fr"]) and at
    assert lang in ("de", "fr") and 0 < score < 1
    assert all(text[a].isalpha() and text[b - 1].isalpha() for a, b, _ in spans)
    assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))


def test_scripts_narrow_the_candidates(spark):
    rows = [(i, f"this is the english text number {i} with words", "en") for i in range(40)]
    rows += [(100 + i, f"это русский текст номер {i} со словами", "ru") for i in range(40)]
    rows += [(200 + i, "αυτό είναι ένα ελληνικό κείμενο", "el") for i in range(40)]
    model = langid.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    labels = [langid.label_texts([t], model)[0] for t in ("qqqq zzzz", "щщщщ", "ωωωω ψψψ", "漢字", "the english текст")]
    assert [d[0] for d in labels[:3]] == ["en", "ru", "el"]
    assert labels[3][0] in model.langs  # a script that nothing was learnt with leaves all
    assert [s[2] for s in labels[4][2]] == ["en", "ru"]


def test_language_cases(spark, model):
    long = " ".join(["Ungheiten die erchen"] * 60_000)
    texts = [None, "", " \n\t", "123 ²½ +-", "\0\0 the \0and of\0", "Ein Ǆ İstanbul ΣΑΣ", "x" * 700_000, long, "é", "é á"]
    rows = [(i, t, "de", "lang_pred", 0.5) for i, t in enumerate(texts)] + [(7, long, None, "", 1.0), (None, "the and of that", "en", "", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, lang_pred string, score double")
    found = langid.label_documents(docs, model).collect()
    assert len(found) == len(rows)
    got = {}
    for r in found:
        got.setdefault(r.doc_id, []).append(r)
    assert all(got[i][0].lang_pred == "und" and got[i][0].score == 0 and got[i][0].spans == [] for i in range(4))
    assert got[7][0].lang_pred == "de" == got[7][1].lang_pred
    assert got[None][0].lang_pred == "en" and got[4][0].lang_pred == "en"
    assert all(got[i][0].lang_pred in model.langs for i in range(4, 10))
    assert [tuple(s) for s in got[4][0].spans] == [(3, 14, "en")]
    nothing = docs.where("text is null")
    assert {r.lang_pred for r in langid.identify(nothing).collect()} == {"und"}
    assert langid.identify(docs.limit(0)).count() == 0


# --- prefix trie ------------------------------------------------------------------------

NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
TURNS = "conv_id bigint, turn bigint, role string, text string"


def test_trie_of_the_table(spark):
    rows = [tuple(r) for r in read_table(spark, SF, "conversations", "conv_id", "turn", "role", "text").collect()]
    assert rows_of(QUERIES["op12_prefix_trie"](spark, SF), *NODE) == sorted(brute.prefix_trie(rows), key=repr)


def hostile_turns():
    rng = random.Random(3)
    rows = [(rng.choice([None, -25, -20, -3, 0, 1, 2, 3, 20, 21, 22, 23, 40, 41, 45, 61]), rng.choice([None, 0, 1, 1, 2, 3, 4]),
             rng.choice([None, "user", "a"]), rng.choice([None, "", " x", "a b", "hello there you", "a b"])) for _ in range(250)]
    same = [(c, t, "user", f"common {t}") for c in range(100, 140) for t in range(5)]  # copies from the first turn on
    return rows + same + [(80, t, "user", "deep " + "w " * (t % 3)) for t in range(120)] + [(84, 0, "user", "long " * 40_000)] * 2


@pytest.mark.parametrize("chunk", [1 << 16, 16])
def test_trie_cases(spark, monkeypatch, chunk):
    """Also with a list that takes many rounds of folding and splicing, and sums over many blocks."""
    if chunk == 16:
        monkeypatch.setattr(prefixtrie, "BLOCK_BITS", 4)
    rows = hostile_turns()
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], TURNS + ", node int, h string, depth int")
    assert rows_of(prefixtrie.prefix_trie(df, chunk=chunk), *NODE) == sorted(brute.prefix_trie(rows), key=repr)


def test_trie_of_nothing(spark):
    df = spark.createDataFrame([(None, 0, "user", "x")], TURNS)
    assert prefixtrie.prefix_trie(df.limit(0)).count() == 0
    assert prefixtrie.prefix_trie(df).count() == 0


def test_rank_of_a_list_in_any_order(spark):
    rng = random.Random(9)
    order = rng.sample(range(10_000), 300)
    arcs = spark.createDataFrame(list(zip(order, [*order[1:], None])), "arc bigint, succ bigint")
    assert [a for a, _ in sorted(map(tuple, prefixtrie.rank(arcs, chunk=20).collect()), key=lambda r: r[1])] == order


def test_fold_keeps_runs_inside_a_chunk():
    arc, succ = np.array([1, 2, 3, 7, 9]), np.array([2, 3, 50, 1, -1])
    head, offset, following, length = prefixtrie.fold_chunk(arc, succ, np.array([1, 1, 2, 5, 1]))
    assert head.tolist() == [7, 7, 7, 7, 9] and offset.tolist() == [5, 6, 7, 0, 0]
    assert following[3] == 50 and length[3] == 9 and following[4] == -1 and length[4] == 1


# --- spelling variants -------------------------------------------------------------------

WORD = ("word", "form", "root", "n", "n_near", "form_n")


def test_spelling_of_the_table(spark):
    docs = [tuple(r) for r in read_table(spark, SF, "documents", "doc_id", "text").collect()]
    want = brute.spelling(docs)
    assert rows_of(QUERIES["op13_spelling"](spark, SF), *WORD) == sorted(want, key=repr)
    assert any(r[1] for r in want) and any(r[1] and r[1] != r[2] for r in want)


def test_spelling_cases(spark):
    rng = random.Random(11)
    base = ["hello", "wörld", "aabbcc", "mississippi", "étéétéé", "ÿÿÿÿÿÿ", "banana"]

    def vary(w):
        i, c = rng.randrange(len(w)), rng.choice("abcéÿ×÷")
        return rng.choice([w, w, w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:], w.upper()])

    texts = [" ".join(vary(rng.choice(base)) for _ in range(120)) for _ in range(30)]
    long = "z" * 30_000
    texts += [None, "", "12 !", long, long, long, long + "y", f"{long}y {long}y", "Ωhello hello日", "ǅhello", "helloŒuvre"] + ["hallo hullo"] * 4
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, texts[3]), (None, "hello helloo helloo"), (None, "helloo hello")]
    df = spark.createDataFrame([(*r, 1, "w", 5) for r in rows], "doc_id bigint, text string, n int, word string, wid int").repartition(5)
    assert rows_of(spelling.spelling_variants(df), *WORD) == sorted(brute.spelling(rows), key=repr)
    assert spelling.spelling_variants(df.limit(0)).count() == 0


def test_blocks_of_a_long_text_count_alike(monkeypatch):
    text = " ".join(f"Word{'é' * (i % 4)}s-{i % 7}x" for i in range(3000))
    whole = sum(spelling.noted_runs(5, text), start=__import__("collections").Counter())
    monkeypatch.setattr(spelling, "BLOCK_CHARS", 37)
    assert sum(spelling.noted_runs(5, text), start=__import__("collections").Counter()) == whole


def test_node_numbers_of_many_parts(spark):
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(400)})
    df = spark.createDataFrame([(w,) for w in words], "word string").repartition(7)
    for reverse in (False, True):
        got = {r.word: r.x for r in spelling.number_nodes(df, "x", reverse).collect()}
        node = {}
        for w in words:
            assert len(got[w]) == len(w) + 1
            for i, number in enumerate(got[w]):
                assert node.setdefault(w[len(w) - i:] if reverse else w[:i], number) == number
        assert len(set(node.values())) == len(node)
    ends = [spelling.number_nodes(df, "x").where(f"word = '{w}'").first().x[-1] for w in words[:5]]
    assert ends == sorted(ends)
