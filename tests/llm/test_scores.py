"""Quality and toxicity: held-out accuracy, the model's arithmetic, and edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import rows_of
from orderpulse.llm import quality, toxicity
from orderpulse.llm.common import read_table

SF = "/root/testdata/sf0.01"
DOC_SCHEMA = "doc_id bigint, text string, x string, score string, h string, y string, label int"
EDGE = [(900001, None), (900002, ""), (900003, " \n\t"), (900004, "word " * 50_000), (None, "no id"), (5, "same id again"), (5, "same id again")]


def auc(scores, labels):
    pos, neg = [s for s, y in zip(scores, labels) if y], [s for s, y in zip(scores, labels) if not y]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def held_out_pairs(spark, scored, label):
    labels = read_table(spark, SF, "labels").where(quality.held_out()).select("doc_id", label)
    rows = scored.join(labels, "doc_id").select("score", label).collect()
    return [r[0] for r in rows], [r[1] for r in rows]


@pytest.mark.parametrize("module, label, least", [(quality, "quality", 0.97), (toxicity, "toxic", 0.75)])
def test_held_out_scores_rank_the_labels(spark, module, label, least):
    scored = module.score_documents(read_table(spark, SF, "documents"), read_table(spark, SF, "labels"))
    assert scored.count() == read_table(spark, SF, "documents").count()
    assert scored.where("score < 0 or score > 1 or score is null or isnan(score)").count() == 0
    assert auc(*held_out_pairs(spark, scored, label)) >= least


def edge_table(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    rows = [(*r, "x", "s", "h", "y", 1) for r in [*map(tuple, docs.collect()), *EDGE]]
    return spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_score_cases(spark, module, label):
    labels = read_table(spark, "/root/testdata/sf0.001", "labels")
    docs = edge_table(spark)
    got = module.score_documents(docs, labels)
    assert rows_of(got, "doc_id") == rows_of(docs, "doc_id")
    assert got.where("score is null or isnan(score) or score not between 0 and 1").count() == 0
    twice = [r.score for r in got.where("doc_id = 5").collect()]
    assert len(set(twice)) <= 2
    assert module.score_documents(docs.limit(0), labels).count() == 0
    # without labels (or with one kind) every row still gets a score
    for some in (labels.limit(0), labels.where(F.col(label) == 0), labels.withColumn(label, F.lit(None).cast("int"))):
        assert module.score_documents(docs, some).where("score between 0 and 1").count() == docs.count()


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_labels_of_the_held_out_fold_are_never_used(spark, module, label):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    flipped = labels.withColumn(label, F.when(quality.held_out(), 1 - F.col(label)).otherwise(F.col(label)))
    a, b = (rows_of(module.score_documents(docs, lab), "doc_id", F.round("score", 9)) for lab in (labels, flipped))
    assert a == b


def test_good_rows_stay(spark):
    labels, docs = read_table(spark, SF, "labels"), read_table(spark, SF, "documents")
    kept = quality.keep_good(docs, labels, 0.3)
    assert kept.columns == docs.columns
    want = quality.score_documents(docs, labels).where("score >= 0.3")
    assert rows_of(kept, "doc_id") == rows_of(want, "doc_id")
    assert quality.keep_good(docs.limit(0), labels, 0.3).count() == 0


def test_discriminant_is_the_normal_density():
    """Scores against the densities written out, without Cholesky factors."""
    rng = np.random.default_rng(0)
    x = {0: rng.normal(0, 1, (300, 3)) @ np.diag([1, 2, 0.5]), 1: rng.normal(1, 1, (500, 3))}
    model = quality.Discriminant({y: (float(len(v)), v.sum(0), v.T @ v) for y, v in x.items()}, 0.2, 0.05)
    cov = {y: np.cov(v.T, bias=True) for y, v in x.items()}
    pooled = (300 * cov[0] + 500 * cov[1]) / 800
    log = {}
    at = rng.normal(0, 1, (20, 3))
    for y, n in ((0, 300), (1, 500)):
        c = 0.8 * cov[y] + 0.2 * pooled
        c = 0.95 * c + 0.05 * np.trace(c) / 3 * np.eye(3)
        d = at - x[y].mean(0)
        log[y] = -0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d) - 0.5 * np.log(np.linalg.det(c)) + np.log(n / 800)
    assert np.allclose(model.score(at), 1 / (1 + np.exp(log[0] - log[1])))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automata_find_what_edit_distance_finds():
    rng = random.Random(4)
    letters = "abcd"
    terms = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(4, 12))) for _ in range(60)})
    trie = toxicity.Trie(terms)
    for _ in range(3000):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(1, 14)))
        assert trie.exact(word) == (word if word in terms else None)
        near = [(edits(word, t), toxicity.allowed_edits(t)) for t in terms if t[0] == word[0] and len(t) > 4]
        best = min((d for d, most in near if d <= most), default=None)
        got = trie.fuzzy(word)
        assert (got[1] if got else None) == best
        if got:
            assert edits(word, got[0]) == got[1]


def test_openings_match_words_and_misspelt_words():
    trie = toxicity.Trie(["lowei*", "idiot"])
    assert trie.exact("loweischaft") == "lowei*" and trie.exact("lowei") == "lowei*" and trie.exact("lowe") is None
    assert trie.exact("idiots") is None and trie.fuzzy("idiots") == ("idiot", 1)
    assert trie.fuzzy("loveischaft") == ("lowei*", 1) and trie.fuzzy("laveischaft") is None


def test_quotation_counts_apart_from_abuse():
    m = toxicity.Matcher(["idiot"])
    names = toxicity.FEATURES
    abuse = dict(zip(names, m.statistics("you are an idiot and you know that")))
    quoted = dict(zip(names, m.statistics('the word "idiot" comes from greek')))
    misspelt = dict(zip(names, m.statistics("you are an idiiot and you know that")))
    assert abuse["hits"] > 0 and abuse["quoted"] == 0
    assert quoted["hits"] == 0 and quoted["quoted"] > 0
    assert misspelt["hits"] == 0 and misspelt["misspelt"] > 0
    assert m.statistics(None) == m.statistics("") == m.statistics("clean text")


def test_only_copies_and_near_copies_fold(spark):
    """Every different labelled text counts for the lexicon, also where texts share their most frequent words."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    texts = {" ".join(rng.choices(words, weights, k=60)) for _ in range(400)}
    base = [f"base{i}" for i in range(60)]
    near = [" ".join(base[:k] + [f"new{k}"] + base[k + 1:]) for k in range(60)]
    rows = [(t, k % 2) for k, t in enumerate(sorted(texts))]
    rows += [(" ".join(reversed(t.split())), y) for t, y in rows[:50]] + [(t, 1) for t in near]
    got = toxicity.one_of_copies(spark.createDataFrame(rows, "text string, y int")).collect()
    assert {(frozenset(t.split()), y) for t, y in rows[:400]} <= {(frozenset(r.text.split()), r.y) for r in got}
    assert len([r for r in got if "w0" in r.text.split() or "base" not in r.text]) == 400
    assert 1 <= len([r for r in got if "base" in r.text]) <= 10


def edits_and_swaps(a, b):
    d = [[max(i, j) if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_automata_with_swaps_find_all_misspellings():
    rng = random.Random(5)
    terms = sorted({"".join(rng.choice("abcde") for _ in range(rng.randint(2, 13))) for _ in range(60)})
    most = {t: 0 if len(t) < 4 else 1 if len(t) < 10 else 2 for t in terms}
    trie, openings = toxicity.Trie(terms), toxicity.Trie([t + "*" for t in terms if len(t) > 3])
    found = 0
    for _ in range(3000):
        word = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(word))
            kind = rng.randrange(4)
            word[i:i + 1 + (kind == 3)] = {0: [], 1: [rng.choice("abcde")], 2: [word[i], rng.choice("abcde")], 3: word[i:i + 2][::-1]}[kind]
            word = word or ["a"]
        word = "".join(word)
        best = min((d for t in terms if (d := edits_and_swaps(word, t)) <= most[t] and len(t) > 3), default=None)
        got = trie.fuzzy(word, narrow=False)
        assert (got[1] if got else None) == best, (word, got, best)
        best = min((d for t in terms if len(t) > 3 for j in range(len(word) + 1) if (d := edits_and_swaps(word[:j], t)) <= most[t]), default=None)
        got = openings.fuzzy(word, narrow=False)
        assert (got[1] if got else None) == best, (word, got, best)
        found += bool(best)
    assert found > 300


@pytest.mark.parametrize("word", "scm scmu scuum 1diot 5tupid idoit clwon stupdi id!ot m@ron $tupid st*pid s.tupid".split())
def test_usual_misspellings_are_hits(word):
    m = toxicity.Matcher(["scum", "idiot", "clown", "stupid", "moron"])
    for text in (f"you are {word} and that is known", f"so ({word.upper()}), so-so", word):
        assert dict(zip(toxicity.FEATURES, m.statistics(text)))["misspelt"] > 0
    assert m.hits("an idiot-proof id!ot", toxicity.tokens("an idiot-proof id!ot")) == [(1, "idiot", 0), (3, "id!ot", 1)]
    assert not m.hits("well-known and/or 3.5% x@y.org", toxicity.tokens("well-known and/or 3.5% x@y.org"))


def test_terms_that_clean_rows_quote_stay_in_the_lexicon(spark):
    """Quoted in clean rows, mentioned in a few, of two letters, with combining marks; one misspelling in a clean row."""
    rng = random.Random(9)
    other = lambda: " ".join(rng.choice("abcdefghij") * 3 + str(rng.randrange(300)) for _ in range(12))
    terms = ["idiot", "zq", "\u0915\u092e\u0940\u0928\u093e"]
    rows = [(f"{other()} you {terms[k % 3]} {other()}", 1) for k in range(150)] + [(other(), 0) for _ in range(300)]
    rows += [(f'{other()} the word "{t}" here {other()}', 0) for t in terms for _ in range(20)]
    rows += [(f"{other()} {t} {other()}", 0) for t in terms for _ in range(5)]
    rows += [(f"{other()} idoit {other()}", 0), (f'{other()} "idiott" {other()}', 0), (f'{other()} said idiott {other()}', 0)]
    rows += [(f"{other()} idioms {other()}", 0) for _ in range(3)]
    df = spark.createDataFrame(rows, "text string, y int")
    assert set(terms) <= set(toxicity.learn_lexicon(df))
    assert len(toxicity.learn_lexicon(df, size=2)) == 2
    assert toxicity.look_alikes(df, ["idiot", "idiom"]) == ["idioms"]


def test_many_masked_words_take_linear_time():
    import time

    matcher = toxicity.Matcher(["stupid", "idiot"], ["you"])
    start = time.process_time()
    statistics = matcher.statistics("st*pid you " * 4_000)
    assert time.process_time() - start < 2 and statistics[1] > 8


def test_quality_query_against_brute_force(spark):
    import brute
    from llm_helpers import SF
    from orderpulse.llm.queries import QUERIES

    docs = [tuple(r) for r in read_table(spark, SF, "documents", "doc_id", "text").collect()]
    labels = [tuple(r) for r in read_table(spark, SF, "labels", "doc_id", "quality").collect()]
    want = brute.quality_scores(docs, labels)
    got = QUERIES["op5_quality"](spark, SF).collect()
    assert len(got) == len(docs)
    assert all(abs(r.score - want[r.doc_id]) < 1e-8 and r.predicted == (r.score >= 0.3) for r in got)
