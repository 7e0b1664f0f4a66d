"""Chat formatting, HTML extraction and embedding near-duplicates."""

import hashlib
import random
import re

import numpy as np
import pytest

import brute
from llm_helpers import SF, rows_of
from orderpulse.llm import chat, covertree, html
from orderpulse.llm.common import read_table
from orderpulse.llm.queries import QUERIES

DIGEST = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def digests(turns):
    """From (conv_id, turn, role, text): the result without formatted_chars, from the source itself."""
    convs = {}
    for conv, turn, role, text in turns:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, rows in convs.items():
        rows.sort()
        loss = "".join(t for _, _, r, t in rows if r == "assistant")
        out.append((conv, len(rows), brute.sha("".join(f"{r}\n{t}\n" for _, _, r, t in rows)), len(loss), brute.sha(loss)))
    return sorted(out, key=repr)


def test_chat_of_the_table(spark):
    turns = [tuple(r) for r in read_table(spark, SF, "conversations", "conv_id", "turn", "role", "text").collect()]
    turns += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = QUERIES["op1_chat"](spark, SF)
    assert rows_of(got, *DIGEST[:5]) == digests(turns)
    assert got.where("formatted_chars <= loss_chars").count() == 0


def test_chat_cases(spark):
    turns = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (2, None, None, "no role"),
             (None, 0, "tool x]", "[/ROLE]</s>"), (3, 5, "assistant", "é" * 40_000), (3, 5, "assistant", "é" * 40_000),
             (3, 4, "system", "<s>[SYS] <\\/s> \\"), (4, 0, "assistant", "<s>" * 3_000)]
    df = spark.createDataFrame([(*t, "rendered", 1) for t in turns],
                               "conv_id bigint, turn bigint, role string, text string, rendered string, recovered int")
    formatted = chat.format_turns(df)
    assert rows_of(chat.conversation_digests(formatted), *DIGEST[:5]) == digests(turns)
    for r in formatted.collect():
        assert chat.parse(r.rendered) == [(r.role, r.recovered)]
    assert chat.conversation_digests(chat.format_turns(df.limit(0))).count() == 0


def test_turns_survive_in_one_document():
    """Whole conversations of hostile texts are read back from their joined rendering."""
    rng = random.Random(1)
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "[ANS]", "[/ANS]", "[SYS]", "[ROLE x]", "[/ROLE]", "\\", "<", "[", "/", "]", " ", "\n", "é", "ok",
             "<\\/s>", "[\\\\INST]", "[/", "s>", "INST]"]
    for _ in range(1500):
        turns = [(rng.choice(["user", "assistant", "system", "", "a b]", "tool"]), "".join(rng.choice(parts) for _ in range(rng.randint(0, 8))))
                 for _ in range(rng.randint(1, 5))]
        assert chat.parse("".join(chat.render(*t)[0] for t in turns)) == turns
        for _, text in turns:
            assert chat.unescape(chat.escape(text)) == text


def test_only_conflicting_content_is_escaped():
    assert chat.render("user", "plain [x] <b> text")[2] == 0
    out, back, tries = chat.render("assistant", "</s>[INST] ok [/INST]")
    assert tries == 1 and back == "</s>[INST] ok [/INST]" and out.count("</s>") == 1
    assert chat.parse("<s>[INST] a [/ANS]</s>") is None and chat.parse("x") is None and chat.parse("<s>[INST] </s> [/INST]</s>") is None


# --- HTML ---------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site name</h1><a href="/">Home</a></header><nav><ul><li><a href="/a">Menu one</a></li><li>Menu two</li></ul></nav>
<div class="cookie-notice">We use cookies on this site <button>OK</button></div><!-- comment text -->
<aside class="sidebar"><p>Side text that is long enough to be read as a paragraph of words.</p></aside>
{content}
<section id="comments"><h2>Comments</h2><p>Great article, I read every word of it twice, thanks a lot.</p></section>
<form><label>Mail</label><input value="x"><textarea>typed</textarea></form><footer><p>&copy; all rights reserved by the site</p></footer></body></html>"""
ARTICLE = """<h1>Fish &amp; chips</h1><p>First  paragraph
with <b>bold</b>, <a href="x">a link</a> and&nbsp;entities &lt;b&gt; &#233;.</p><div class="ad">Buy now! Buy now! Buy now!</div>
<p>Second paragraph, never closed<p>Third one.<br>After a break.</p><ul><li>item one</li><li>item two</li></ul><noscript>off</noscript>
<blockquote>A quote.</blockquote>"""
TEXT = ("Fish & chips First paragraph with bold, a link and entities <b> é. Second paragraph, never closed "
        "Third one. After a break. item one item two A quote.")


@pytest.mark.parametrize("content", [f"<article>{ARTICLE}</article>", f"<main>{ARTICLE}</main>", f'<div id="content">{ARTICLE}</div>'])
def test_the_article_is_extracted(content):
    assert html.extract(PAGE.replace("{content}", content)) == TEXT


@pytest.mark.parametrize("wrapper", ['div class="container with-sidebar"', 'div class="no-sidebar"', 'div class="comments-open"',
                                     'div class="has-banner"', "form", 'div class="page widget"'])
@pytest.mark.parametrize("content", ["article", "main", "div"])
def test_a_wrapper_round_the_page_sets_nothing_aside(wrapper, content):
    page = PAGE.replace("{content}", f"<{content}>{ARTICLE}</{content}>")
    body = re.sub(r"(<body[^>]*>)(.*)(</body>)", rf"\1<{wrapper}>\2</{wrapper.split()[0]}>\3", page, flags=re.S)
    assert body != page and html.extract(body) == TEXT
    hidden = f'<div style="display:none"><article>{ARTICLE}</article></div>'
    assert html.extract(hidden) == ""


def test_math_text_stays_and_comments_stay_out():
    assert html.extract("<article><p>so <math><mi>a</mi><mo>=</mo><mn>2</mn></math> holds</p></article>") == "so a=2 holds"
    page = f'<article>{ARTICLE}</article><div class="comments"><article><p>{"many words " * 500}</p></article></div>'
    assert html.extract(page) == TEXT


def test_html_of_the_table(spark):
    import re
    from html import unescape

    def inside(page):
        m = re.search(r"<article[^>]*>(.*?)</article>", page, re.S)
        text = re.sub(r"<[^>]+>", "", re.sub(r"</?(?:p|h\d|br|div|li|ul)\b[^>]*>", " ", m[1]))
        return " ".join(unescape(text).split())

    pages = read_table(spark, SF, "pages").collect()
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in QUERIES["op2_html"](spark, SF).collect()}
    assert got == {p.page_id: (p.url, inside(p.html), len(inside(p.html))) for p in pages}


def test_html_cases(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain words only"), (4, "u", "<p></p>"), (None, "u", f"<article>{ARTICLE}</article>"),
            (5, "u", f"<article>{ARTICLE}</article>"), (5, "u", f"<article>{ARTICLE}</article>"), (6, "u", "<"), (7, "u", "<p>a</b></i><p>b</div>"),
            (8, "u", "<article><p>" + "long word list " * 30_000 + "</p></article>"), (9, "u", "<script>never closed <p>x</p>"),
            (10, "u", "<div>" * 3_000 + "<p>deep words here</p>")]
    df = spark.createDataFrame([(*r, "text", 1) for r in rows], "page_id bigint, url string, html string, text string, n_chars int")
    got = {(r.page_id, r.url): r.text for r in html.extract_pages(df).collect()}
    assert got[1, "u"] == got[2, None] == got[4, "u"] == got[9, "u"] == "" and got[6, "u"] in ("", "<")
    assert got[3, "u"] == "plain words only" and got[None, "u"] == got[5, "u"] == TEXT
    assert got[7, "u"] == "a b" and got[10, "u"] == "deep words here" and len(got[8, "u"]) == len("long word list " * 30_000) - 1
    assert html.extract_pages(df).count() == len(rows) and html.extract_pages(df.limit(0)).count() == 0


def test_best_region_against_all_regions():
    rng = random.Random(2)
    for _ in range(500):
        s = [rng.choice([-2, -1, -0.5, 1, 2]) for _ in range(rng.randint(0, 12))]
        a, b = html.best_region(s)
        assert sum(s[a:b]) == max([0, *(sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1))])


# --- embeddings -------------------------------------------------------------------------------

def vectors(seed=0, n=260, dim=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim))
    rows = [v for v in base]
    rows += [base[0] * (1 + k) for k in range(5)] + [base[1]] * 30
    rows += [base[2] + rng.normal(size=dim) * s for s in np.linspace(0.01, 0.6, 120)]
    rows += [base[3] + (base[4] - base[3]) * t for t in np.linspace(0, 1, 25)]  # a chain from one to the other
    out = [(i * 3, [float(np.float32(c)) for c in v]) for i, v in enumerate(rows)]
    return out + [(-1, None), (-2, []), (-3, [0.0] * dim), (-4, [float("nan")] * dim), (-5, [None] + [1.0] * (dim - 1)),
                  (-6, [float("inf")] * dim), (None, out[0][1]), (6, out[2][1]), (6, out[2][1])]


@pytest.mark.parametrize("block", [2048, 50, 7])
def test_near_vectors_against_all_pairs(spark, block):
    rows = vectors()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id bigint, embedding array<double>, label int, cls string")
    got = covertree.near_vectors(df, block_rows=block)
    assert rows_of(got, "vec_id", "n_links", "component_id") == sorted(brute.near_vectors(rows), key=repr)


@pytest.mark.parametrize("block", [2048, 20])
def test_every_vector_length_is_compared_whole(spark, block):
    """A stray longer vector leaves the links of the others as they are, and shorter vectors link as well."""
    usual = [(i, v) for i, v in vectors(n=40) if v and len(v) == 16]
    other = [(10_000 + (i or 0), v[:5]) for i, v in usual]
    rows = usual + other + [(50_000, [1.0] * 17)]
    got = covertree.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), block_rows=block)
    want = [*brute.near_vectors(usual), *brute.near_vectors(other), (50_000, 0, 50_000)]
    assert rows_of(got, "vec_id", "n_links", "component_id") == sorted(want, key=repr)


def test_near_vectors_of_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in read_table(spark, SF, "embeddings").collect()]
    got = QUERIES["op9_cover_tree"](spark, SF)
    assert rows_of(got, "vec_id", "n_links", "component_id", "kept") == sorted(
        ((v, n, c, v == c) for v, n, c in brute.near_vectors(rows)), key=repr)


def test_near_vectors_of_empty_tables(spark):
    df = spark.createDataFrame(vectors(), "vec_id bigint, embedding array<double>")
    assert covertree.near_vectors(df.limit(0)).count() == 0
    bad = covertree.near_vectors(df.where("vec_id < 0"))
    assert rows_of(bad, "n_links") == [(0,)] * 6


def test_cover_tree_levels():
    """Nested centres, halving radii, and every point within its centre's radius."""
    x = np.array([v for _, v in vectors()[:200]])
    tree = covertree.CoverTree(x, np.arange(200), np.ones(200, int))
    radius = 2.0
    for (above, _, _), (points, parents, radii) in zip(tree.levels, tree.levels[1:-1]):
        radius /= 2
        assert set(above) <= set(points) and (radii <= radius + 1e-9).all() and parents.max() < len(above)
    assert sorted(tree.levels[-1][0]) == list(range(200))


def test_deep_pages_are_read_in_linear_time():
    import time

    for part in ("<div>word ", "<p><b>word ", "<ul><li>word "):
        page = f"<article>{part * 16_000}</article>" + "</i>" * 16_000
        start = time.process_time()
        assert html.extract(page) == " ".join(["word"] * 16_000)
        assert time.process_time() - start < 5  # an eighth of a second and more were spent on a thousand before
