"""HTML extraction by a maximum-scoring subsequence.

A page is a sequence of tokens: words and tags. Words score positive and tags negative, with weights
by kind learnt from labelled pages, and one linear scan finds the contiguous region of the greatest
total: the main content. Kinds of words: in a link or not, in a paragraph, a heading, a list, ...; kinds
of tags: by name. Parts that are no main text wherever they stand (menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles, comments of readers, hidden parts) score next to nothing,
so that one inside the content does not tear it, and are left out of the text; but an element that holds
the page's ``main``, or no fewer articles than the page and most of its paragraph words, is a wrapper.

The weight of a kind is its log-odds of standing inside the content against outside. Labelled pages are
the pages that mark their content themselves (``article`` or ``main``), at most ``SAMPLE`` of them, those
with the smallest hash of the id. Without any, the built-in weights hold.

Defined cases: a null or empty page, or one without words, has empty text; unclosed, crossed and
unknown tags are read like a browser does in these cases (a paragraph ends at the next block); repeated
rows are extracted each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import shipped

SAMPLE = 2_000               # labelled pages that the weights are learnt from
LEAST = 50                   # tokens of a kind that its learnt weight takes; below, the built-in one holds
#: Elements whose content is not text of the page.
RAW = frozenset("script style noscript template textarea iframe svg canvas object title select annotation annotation-xml video audio".split())
#: Elements that never hold main text.
ASIDE = frozenset("nav header footer aside form menu dialog button fieldset search".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end a block of text where they open or close.
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot
th thead tr ul""".split())
#: Words in the class, id or role of an element that say that it is no main text.
BOILER = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert|adverts|advertisement|advertising|banner|breadcrumb|breadcrumbs|comment|comments|complementary|"
    r"contentinfo|cookie|cookies|consent|disclaimer|discussion|disqus|footer|header|login|masthead|menu|menubar|modal|nav|navbar|"
    r"navigation|newsletter|notice|notices|overlay|pager|pagination|popup|promo|promoted|promotion|recommended|related|replies|reply|responses|"
    r"search|share|sharing|sidebar|signup|skip|social|sponsor|sponsored|subscribe|teaser|toolbar|widget)s?(?=$|[\s_-])", re.I)
#: Class words that name a layout, not what the element is.
LAYOUT = re.compile(r"(?:^|(?<=\s))(?:(?:has|no|with|without)[-_]\S+|\S+[-_](?:open|closed))(?=$|\s)", re.I)
WRAPS = 0.8                  # of the page's paragraph words: an element with so many is a wrapper, whatever its class
_TOKEN = re.compile(
    r"<!--(.*?)(?:-->|$)|<!\[CDATA\[(.*?)(?:\]\]>|$)|<[!?][^>]*>?|"
    r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)>?|([^<]+|<)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.S)
#: Weights without labelled pages: a word of text gains, a word of a link and a tag lose.
DEFAULT = {"word:text": 0.5, "word:p": 2.0, "word:heading": 1.0, "word:link": -1.0, "word:list": 1.0, "word:aside": -0.01,
           "tag:aside": -0.01}
TAG_DEFAULT, INLINE_DEFAULT = -0.5, -0.05
_INLINE = frozenset("b i em strong span a br u s small sub sup code q cite mark abbr time font img wbr math mi mn mo ms mtext mspace "
                    "mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle semantics".split())


def read(page: str | None) -> list[tuple[str, str, bool, int]]:
    """Tokens (kind, text, breaks the block, inside the labelled content): a run of words or a tag. Elements
    that are no main text by name or class, but hold the page's content, are read like others."""
    out, held = _read(page, frozenset())
    *_, (words, paragraphs, articles, _) = held
    wrappers = frozenset(k for k, (w, p, a, main) in enumerate(held[:-1]) if main or a == articles and
                         (p >= WRAPS * paragraphs if paragraphs else words and w >= WRAPS * words))
    return _read(page, wrappers)[0] if wrappers else out


def _read(page: str | None, wrappers: frozenset) -> tuple[list[tuple[str, str, bool, int]], list[list[int]]]:
    """The tokens, and of each element that is no main text unless it is one of the ``wrappers``, last of the
    page: [words outside links, of these in paragraphs, articles and mains, mains]."""
    out: list[tuple[str, str, bool, int]] = []
    held: list[list[int]] = []
    page_held = [0, 0, 0, 0]
    within: list[tuple[int, list[int]]] = []  # place in the stack and counts of such elements that are open
    stack: list[tuple[str, bool]] = []  # open elements; whether each is no main text
    deep: Counter = Counter()           # how many elements of a name are open
    aside = content = 0

    def close(depth: int) -> list[int]:
        """Such elements that are no longer open hand their counts to the one around them; returns that one's."""
        while within and within[-1][0] >= depth:
            _, counts = within.pop()
            for k, n in enumerate(counts):
                (within[-1][1] if within else page_held)[k] += n - own.get((id(counts), k), 0)
        return within[-1][1] if within else page_held

    own: dict[tuple[int, int], int] = {}  # what an element counts of itself and its outer ones have counted already
    at, page = 0, page or ""
    while at < len(page):
        m = _TOKEN.match(page, at)
        at = m.end()
        if m[6] is not None or m[2] is not None:
            text = entities.unescape(m[6]) if m[6] is not None else m[2]
            if text:
                counts, paragraph = close(len(stack)), bool(deep["p"] or deep["pre"] or deep["blockquote"])
                if not deep["a"]:
                    n = len(text.split())
                    counts[0] += n
                    counts[1] += n * paragraph
                kind = ("aside" if aside else "p" if paragraph else "link" if deep["a"]
                        else "heading" if any(n in ("h1", "h2", "h3", "h4", "h5", "h6") for n, _ in stack[-3:])
                        else "list" if deep["li"] else "text")
                out.append((f"word:{kind}", text, False, content))
            continue
        name = (m[4] or "").lower()
        if not name:
            continue
        if m[3]:  # a closing tag ends the element and all that is open inside it
            while deep[name]:
                n, off = stack.pop()
                deep[n] -= 1
                aside -= off
                content -= n in ("article", "main")
                if n == name:
                    break
        else:
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                at = end.end() if end else len(page)
                continue
            if name in BLOCK:  # paragraphs and headings end where a block opens; items and cells where the next does
                ends = {"p"} | ({name} if name in ("li", "dt", "dd", "tr", "td", "th", "option") else set())
                while stack and (stack[-1][0] in ends or stack[-1][0] in _INLINE and any(n in ends for n, _ in stack[-2:])):
                    n, off = stack.pop()
                    deep[n] -= 1
                    aside -= off
            said = m[5] or ""
            off = name in ASIDE and not (name == "header" and content)
            hidden = False
            if "=" in said or "hidden" in said:
                told = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(said)}
                labels = " ".join(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", told.get(k) or "") for k in ("class", "id", "role", "aria-label"))
                off = off or (name not in ("html", "body", "main") and bool(BOILER.search(LAYOUT.sub(" ", labels))))
                hidden = told.get("aria-hidden") == "true" or "display:none" in (told.get("style") or "").replace(" ", "") or \
                    bool(re.search(r"(?:^|\s)hidden(?:$|[\s/])", _ATTRIBUTE.sub(" ", said)))
            if name not in VOID and not said.rstrip().endswith("/"):
                counts = close(len(stack))
                if name in ("article", "main"):
                    counts[2] += 1
                    counts[3] += name == "main"
                if off and not hidden:
                    held.append([0, 0, int(name == "article"), 0])
                    own[id(held[-1]), 2] = held[-1][2]  # counted for the outer ones when it opened
                    within.append((len(stack), held[-1]))
                    off = len(held) - 1 not in wrappers
                off = off or hidden
                stack.append((name, bool(off)))
                deep[name] += 1
                aside += bool(off)
                content += name in ("article", "main")
        out.append(("tag:aside" if aside and name != "br" else f"tag:{name}", "", name in BLOCK, content))
    close(0)
    return out, [*held, page_held]


def weight(kind: str, weights: dict[str, float]) -> float:
    if kind in weights:
        return weights[kind]
    if kind in DEFAULT:
        return DEFAULT[kind]
    return INLINE_DEFAULT if kind[4:] in _INLINE else TAG_DEFAULT


def best_region(scores) -> tuple[int, int]:
    """[start, end) of the contiguous run of the greatest positive sum, the first and longest of equals."""
    best, at, total, start = (0.0, 0, 0), 0, 0.0, 0
    for at, s in enumerate(scores):
        if total < 0:
            total, start = 0.0, at
        total += s
        if total > best[0] or total == best[0] > 0 and start == best[1]:
            best = (total, start, at + 1)
    return best[1], best[2]


def extract(page: str | None, weights: dict[str, float] | None = None) -> str:
    """Main text: words of the best region outside asides, blocks joined by one space."""
    found = read(page)
    weights = weights or {}
    scores = [weight(k, weights) * (max(1, t.count(" ") + 1) if k.startswith("word:") and t.strip() else k.startswith("tag:"))
              for k, t, _, _ in found]
    a, b = best_region(scores)
    blocks, block = [], []
    for kind, text, breaks, _ in found[a:b]:
        if kind == "tag:br":
            block.append(" ")
        elif breaks:
            blocks.append("".join(block))
            block = []
        elif kind.startswith("word:") and kind != "word:aside":
            block.append(text)
    blocks.append("".join(block))
    return " ".join(x for x in (" ".join(t.split()) for t in blocks) if x)


def learn_weights(pages: DataFrame, sample: int = SAMPLE, id_col: str = "page_id", html_col: str = "html") -> dict[str, float]:
    """Log-odds of the kinds inside the labelled content against outside, over at most ``sample`` pages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, outside = Counter(), Counter()
        for batch in batches:
            for page in batch.column(0):
                for kind, text, _, content in read(page.as_py()):
                    n = len(text.split()) if kind.startswith("word:") else 1
                    (inside if content else outside)[kind] += n
        kinds = sorted(inside.keys() | outside.keys())
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array([inside[k] for k in kinds], pa.int64()),
                                          pa.array([outside[k] for k in kinds], pa.int64())], ["kind", "n1", "n0"])

    marked = pages.where(F.col(html_col).rlike("(?i)<(article|main)[\\s>]"))
    chosen = marked.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(id_col)).alias("_h")).orderBy("_h", "_id").limit(sample)
    few = pages.join(F.broadcast(chosen.select("_id").distinct()), pages[id_col] == F.col("_id")).select(html_col)
    counts = (shipped(few).mapInArrow(run, "kind string, n1 bigint, n0 bigint").groupBy("kind")
              .agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")))
    counts = counts.persist()
    n1, n0 = counts.agg(F.sum("n1"), F.sum("n0")).first()
    # kinds that occur often enough in the sample: no more than its tokens over LEAST, whatever names pages use
    often = counts.where(F.col("n1") + F.col("n0") >= LEAST).collect()
    counts.unpersist()
    if not n1 or not n0:
        return {}
    weights = {}
    for r in often:
        odds = float(np.clip(np.log((r.n1 + 0.5) / (n1 + 1)) - np.log((r.n0 + 0.5) / (n0 + 1)), -4, 4))
        if r.kind not in ("word:aside", "tag:aside"):  # tags score negative, if only just
            weights[r.kind] = odds if r.kind.startswith("word:") else min(odds, -0.005)
    return weights


def extract_pages(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(page_id, url, text) of every page."""
    weights = learn_weights(pages.select("page_id", "html"), sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(p.as_py(), weights) for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                             ["page_id", "url", "text"])

    three = shipped(pages).select(F.col("page_id").cast("bigint"), "url", "html")
    return three.mapInArrow(run, "page_id bigint, url string, text string")
