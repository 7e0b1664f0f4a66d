r"""Personal data by weak supervision, with DataFrame functions only.

Base spans are the matches of four patterns that pass their checks (octets, Luhn, digit counts). Further
candidates are looser forms of the same kinds (an address written with "[at]", a number without the
plus, grouped digits with other separators). Matches of the base patterns that fail their checks (years,
amounts, versions) are candidates too, but never added: they show what personal data is not. Labelers vote
on every candidate: the base pattern and its check (regex; no vote on looser forms), lists of cue words near the
span (gazetteer), the words right before it (context), the checks of its digits or domain (form), and what
speaks against it (a longer number around it, a version or price). A labeler votes for, against or not at all.

Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is when it votes and
how likely each pattern is personal data. Prior counts and a sign constraint hold every labeler at or above
chance, so that a table with few spans of one class cannot turn one round. A logistic span classifier is trained on
these posteriors and decides the candidates outside the base spans. Base spans always stay.

EM and classifier work on the table of vote patterns, at most 4 kinds times 3^5 rows however many
spans there are. Spans are read off from the pieces between matches and their lengths, and cues from the
pieces beside a match, so the work grows with the text however many matches it has.

Defined cases: a null or empty text has no spans; repeated rows are searched each; a document
without candidates has empty lists; without any candidates nothing is learnt or added; other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
#: The base patterns. Possessive loops and the start at a run's first character (or where the last match
#: ended) match the same spans as the plain forms and need neither backtracking nor a deep stack.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Looser forms, and what a text must hold for them to be tried.
LOOSE = {
    "email": r"[A-Za-z0-9._%+-]++ ?(?:\[at\]|\(at\)|\{at\}|＠| @ ) ?[A-Za-z0-9-]++(?: ?(?:\.|\[dot\]|\(dot\)|\{dot\}) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:(?:\[\.\]|\(\.\)|\[dot\])[0-9]{1,3}+){3}(?![0-9.])",
    "card": r"(?<![0-9./])[0-9]{4}([./_]|  )[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9./])",
    "phone": r"(?<![0-9+(.-]|[0-9+]\x20)(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9-])",
}
QUICK = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
LOOSE_QUICK = {"email": r"[\[({]at[\])}]|＠| @ ", "ip": r"[0-9][\[(](?:\.|dot)[\])][0-9]", "card": r"[0-9]{4}(?:[./_]|  )[0-9]{4}",
               "phone": r"[0-9]{3}[-.) ]\x20?[0-9]{3}[-.\x20][0-9]{4}"}
#: Cue words by kind, in the languages of the corpora.
CUES = {
    "email": r"mail|contact|write|reach|kontakt|correo|courriel|adresse|escrib",
    "ip": r"\bip\b|host|server|address|addr|login|client|from|serveur|servidor|adresse",
    "card": r"card|visa|master|amex|credit|debit|karte|carte|tarjeta|pay",
    "phone": r"phone|tel|call|mobile|cell|fax|ring|telefon|anruf|appel|llam|whatsapp",
}
AGAINST = r"(?:version|\bv|release|section|isbn|issn|order|invoice|figure|table|chapter|\$|€|£|#)[ :.]*$"
LABELERS = ("regex", "gazetteer", "context", "form", "against")
NEAR, BEFORE = 60, 16        # characters looked at by gazetteer and context
EM_STEPS = 60
PRIOR_RIGHT, PRIOR_WRONG = 3.0, 1.0  # votes that every labeler is credited with before any is seen
START = (1.0, 0.5, 1.0, 1.0, 1.0)
CUT = 0.5


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    doubled = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda d: d != ""),
                          lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
                              F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)))
    return F.aggregate(doubled, F.lit(0), lambda s, d: s + d) % 10 == 0


def passes(kind: str, x: Column) -> Column:
    """The check of a match of the kind."""
    if kind == "ip":
        parts = F.transform(F.split(F.regexp_replace(x, r"[^0-9]+", "."), r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    if kind == "card":
        return F.length(_digits(x)).between(12, 19) & luhn(_digits(x))
    if kind == "phone":
        return F.length(_digits(x)).between(9, 15)
    return F.lit(True)


def _when(text: str, quick: str, value: Column, empty: Column) -> Column:
    test = F.contains(F.col(text), F.lit(quick)) if len(quick) == 1 else F.col(text).rlike(quick)
    return F.when(test, value).otherwise(empty)


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0).cast("bigint"), lambda s, n: s + n)


def _runs(lengths: str) -> Column:
    """Sums of runs of 64 of an array."""
    last = F.greatest(F.floor((F.size(lengths) - 1) / 64), F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda b: _sum(F.slice(F.col(lengths), b * 64 + 1, F.lit(64))))


def _before_runs(runs: str) -> Column:
    """Sum of the runs before each run. Named twice, as all arrays that a lambda reads: what is named once,
    the optimizer writes into the lambda and works out again for every element."""
    return F.transform(F.sequence(F.lit(1), F.size(runs)), lambda b: _sum(F.slice(F.col(runs), F.lit(1), b - 1)))


def _prefix(lengths: str, i: Column) -> Column:
    """Sum of the first ``i`` of an array: the runs before, and what is left of its own run."""
    run = F.floor((i - 1) / 64).cast("int")
    before = F.when(F.size(f"{lengths}_runs") > run, F.get(F.col(f"{lengths}_runs"), run))
    return before + _sum(F.slice(F.col(lengths), run * 64 + 1, i - run * 64))


def _spans(group: str, kind: str) -> Column:
    """(start, stop, k, votes, ok) of the matches of one form; ``ok``: passes its check, or is a looser form."""
    name = f"{group}_{kind}"
    each = F.transform(f"{name}_m", lambda m, i: F.struct(
        m.alias("m"), _prefix(f"{name}_l", i + 1).alias("stop"), F.get(F.col(f"{name}_p"), i).alias("left"),
        F.get(F.col(f"{name}_p"), i + 1).alias("right"), (passes(kind, m) if group == "base" else F.lit(True)).alias("ok")))
    return F.transform(each, lambda s: F.struct(
        (s["stop"] - F.length(s["m"])).alias("start"), F.lit(KINDS.index(kind)).alias("k"), s["stop"].alias("stop"),
        votes(kind, group == "base", s).alias("votes"), s["ok"].alias("ok")))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, loose, failed): arrays of (start, k, stop, votes) of the base spans and of the looser
    candidates of every text, and (k, votes) of the base matches that fail their check; ``k`` numbers the
    kinds and ``votes`` holds one vote a labeler."""
    none = F.array().cast("array<string>")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    forms = [(f"{group}_{kind}", pattern[kind], quick[kind]) for group, pattern, quick in
             (("base", BASE, QUICK), ("loose", LOOSE, LOOSE_QUICK)) for kind in KINDS]
    made = {}
    for name, pattern, quick in forms:
        made[f"{name}_m"] = _when("text", quick, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), none)
    rows = rows.withColumns(made)
    pieces = {f"{name}_p": F.when(F.size(f"{name}_m") > 0, F.split("text", pattern, -1)).otherwise(none) for name, pattern, _ in forms}
    rows = rows.withColumns(pieces)
    # length of each piece with the match after it, and the sums before runs of 64 of them
    rows = rows.withColumns({f"{n}_l": F.zip_with(F.slice(f"{n}_p", 1, F.size(f"{n}_m")), f"{n}_m",
                                                 lambda p, m: (F.length(p) + F.length(m)).cast("bigint")) for n, _, _ in forms})
    rows = rows.withColumns({f"{n}_s": _runs(f"{n}_l") for n, _, _ in forms})
    rows = rows.withColumns({f"{n}_l_runs": _before_runs(f"{n}_s") for n, _, _ in forms})
    rows = rows.withColumns({n: _spans(*n.split("_")) for n, _, _ in forms})
    span = lambda c: F.struct(c["start"].alias("start"), c["k"].alias("k"), c["stop"].alias("stop"), c["votes"].alias("votes"))
    matched, looser = (F.flatten(F.array(*(f"{g}_{k}" for k in KINDS))) for g in ("base", "loose"))
    rows = rows.select("doc_id", matched.alias("matched"), F.array_sort(F.transform(looser, span)).alias("loose"))
    rows = rows.select("doc_id", F.array_sort(F.transform(F.filter("matched", lambda c: c["ok"]), span)).alias("base"), "loose",
                       F.transform(F.filter("matched", lambda c: ~c["ok"]), lambda c: F.struct(c["k"].alias("k"), c["votes"].alias("votes"))
                                   ).alias("failed"))
    # a candidate that a base span touches is that span
    free = F.filter("loose", lambda c: ~F.exists("base", lambda b: (b["start"] < c["stop"]) & (c["start"] < b["stop"])))
    return rows.withColumn("loose", F.when(F.size("loose") > 0, free).otherwise(F.col("loose")))


def votes(kind: str, base: bool, span: Column) -> Column:
    """One vote a labeler: 1 for, -1 against, 0 none. ``span`` holds the match ``m``, the text from the match
    before (``left``) and up to the match after (``right``), and whether it is ``ok``."""
    match = span["m"]
    before = F.lower(F.right(span["left"], F.lit(BEFORE)))
    around = F.lower(F.concat_ws(" ", F.right(span["left"], F.lit(NEAR)), F.left(span["right"], F.lit(NEAR))))
    beside = F.concat_ws(" ", F.right(span["left"], F.lit(1)), F.left(span["right"], F.lit(1)))
    if kind == "email":
        form = match.rlike(r"(?i)(?:\.|dot[\])}]) ?[a-z]{2,24}$")
    elif kind == "phone":
        form = F.length(_digits(match)).between(10, 15)
    else:
        form = passes(kind, match)
    return F.concat_ws(",", *(v.cast("string") for v in (
        F.when(span["ok"], 1).otherwise(-1) if base else F.lit(0),
        F.when(around.rlike(CUES[kind]), 1).otherwise(0),
        F.when(before.rlike(rf"(?:{CUES[kind]})[a-z]*[ :=.#]*$"), 1).otherwise(0),
        F.when(form, 1).otherwise(-1),
        F.when(before.rlike(AGAINST) | beside.rlike(r"[0-9A-Za-z_]"), -1).otherwise(0))))


def vote_patterns(found: DataFrame) -> list[tuple[int, tuple[int, ...], int]]:
    """(kind, votes, count) of every pattern that occurs; at most 4 * 3^5 rows."""
    voted = lambda c: F.struct(c["k"].alias("k"), c["votes"].alias("votes"))
    each = found.select(F.explode(F.concat(F.transform(F.concat("base", "loose"), voted), "failed")).alias("s"))
    rows = each.groupBy(F.col("s.k").alias("k"), F.col("s.votes").alias("votes")).count().orderBy("k", "votes").collect()
    return [(r.k, tuple(int(v) for v in r.votes.split(",")), r["count"]) for r in rows]


def reliabilities(patterns, steps: int = EM_STEPS) -> dict[tuple[int, tuple[int, ...]], float]:
    """Probability of personal data of each (kind, votes), by expectation-maximisation of the model in which
    labelers that vote do so independently given the truth (no vote tells nothing). It starts from the
    majority of votes, with both classes; a vote that came out worse than chance counts for nothing."""
    post = {(k, v): min(0.95, max(0.05, 0.5 + 0.2 * sum(v))) for k, v, _ in patterns}
    for _ in range(steps):
        prior, told = {}, {}
        for k in {k for k, _, _ in patterns}:
            n = sum(c for q, _, c in patterns if q == k)
            prior[k] = (sum(c * post[q, v] for q, v, c in patterns if q == k) + 1) / (n + 2)
        for labeler in range(len(LABELERS)):
            share = {}
            for truth in (0, 1):
                weight = {vote: sum(c * (post[k, v] if truth else 1 - post[k, v]) for k, v, c in patterns if v[labeler] == vote)
                          for vote in (-1, 1)}
                right = 1 if truth else -1
                share[truth] = (weight[1] + (PRIOR_RIGHT if right == 1 else PRIOR_WRONG)) / (sum(weight.values()) + PRIOR_RIGHT + PRIOR_WRONG)
            told[labeler, 1] = max(0.0, math.log(share[1] / share[0]))
            told[labeler, -1] = min(0.0, math.log((1 - share[1]) / (1 - share[0])))
            told[labeler, 0] = 0.0
        for k, v, _ in patterns:
            odds = math.log(prior[k] / (1 - prior[k])) + sum(told[j, x] for j, x in enumerate(v))
            post[k, v] = 1 / (1 + math.exp(-max(-50, min(50, odds))))
    return post


def train(patterns) -> list[float]:
    """Weights of the span classifier (one a labeler, then one a kind), by gradient steps on the posteriors, each
    pattern weighed by the logarithm of its count. Weights are drawn to ``START`` where the patterns say nothing,
    and no labeler's gets below zero."""
    post = reliabilities(patterns)
    start = [*START, *[0.0] * len(KINDS)]
    w = list(start)
    rows = [([*v, *[float(k == q) for q in range(len(KINDS))]], post[k, v], math.log1p(c)) for k, v, c in patterns]
    total = sum(c for _, _, c in rows) or 1.0
    for _ in range(500):
        grad = [0.0] * len(w)
        for x, p, c in rows:
            at = 1 / (1 + math.exp(-max(-50, min(50, sum(a * b for a, b in zip(w, x))))))
            for i, a in enumerate(x):
                grad[i] += c * (at - p) * a
        w = [a - 0.5 * (g / total + 0.02 * (a - a0)) for a, g, a0 in zip(w, grad, start)]
        w = [max(a, 0.0) if i < len(LABELERS) else a for i, a in enumerate(w)]
    return w


def keep(span: Column, weights: list[float]) -> Column:
    """Whether the classifier takes the candidate."""
    given = F.split(span["votes"], ",")
    score = F.lit(0.0)
    for i in range(len(LABELERS)):
        score = score + F.element_at(given, i + 1).cast("double") * weights[i]
    for k in range(len(KINDS)):
        score = score + F.when(span["k"] == k, weights[len(LABELERS) + k]).otherwise(0.0)
    return score > math.log(CUT / (1 - CUT))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, spans): the base spans and all spans, sorted by start, then kind."""
    found = stored(find(docs, id_col, text_col), "pii-candidates")
    patterns = vote_patterns(found)
    weights = train(patterns) if patterns else [0.0] * (len(LABELERS) + len(KINDS))
    added = F.filter("loose", lambda c: keep(c, weights))
    return found.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def joined(spans: str) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["k"] + 1), s["start"], s["stop"])), ",")
