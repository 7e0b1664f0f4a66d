"""Chat formatting with a grammar round trip.

A conversation is the concatenation of its turns in order, and a turn is

    <s>[INST] text [/INST]</s>          with the marker of its role: SYS, INST, ANS,
    <s>[ROLE name] text [/ROLE]</s>     or the role's name, percent-encoded, for any other role.

Control strings are ``<s>``, ``</s>`` and the bracketed markers. Inside a text one is escaped by a backslash
after its first character (and one more where backslashes stand there already), which is undone
exactly. Each turn is first rendered as it is; a deterministic parser reads the rendering back, and
where the turns recovered differ from the source, the conflicting content is escaped and the
turn is read back again, until both are identical.

Turns are rendered and read back one by one, so a conversation with very many turns is spread over all
tasks. What needs their order (digests) streams through turns sorted by conversation, and holds
one running hash whatever the length.

Defined cases: a null or empty text is an empty turn; a null role is a role of empty name; turns of
equal number are ordered by role and text; repeated rows are turns of their own; a null conv_id
is a conversation; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import shipped

MARKERS = {"system": "SYS", "user": "INST", "assistant": "ANS"}
ROLES = {m: r for r, m in MARKERS.items()}
LOSS_ROLE = "assistant"
#: A control string's opening bracket and the backslashes after it.
_ANY = re.compile(r"(<)(\\*)(?=/?s>)|(\[)(\\*)(?=/?(?:SYS|INST|ANS|ROLE)\]|ROLE )")
_TURN = re.compile(r"<s>\[(?:(SYS|INST|ANS)|ROLE ([^\]\s]*))\] (.*?) \[/(SYS|INST|ANS|ROLE)\]</s>", re.S)


def escape(text: str) -> str:
    return _ANY.sub(lambda m: (m[1] or m[3]) + (m[2] or m[4] or "") + "\\", text)


def unescape(text: str) -> str:
    return _ANY.sub(lambda m: (m[1] or m[3]) + (m[2] or m[4] or "")[:-1], text)


def open_close(role: str) -> tuple[str, str]:
    mark = MARKERS.get(role)
    return (f"<s>[{mark}] ", f" [/{mark}]</s>") if mark else (f"<s>[ROLE {quote(role, safe='')}] ", " [/ROLE]</s>")


def parse(rendered: str) -> list[tuple[str, str]] | None:
    """Turns (role, text) of a rendered conversation, or None where it isn't one."""
    at, turns = 0, []
    while at < len(rendered):
        m = _TURN.match(rendered, at)
        if not m or m[4] != (m[1] or "ROLE"):
            return None
        body = m[3]
        if any(not (c[2] or c[4]) for c in _ANY.finditer(body)):  # an unescaped control string
            return None
        turns.append((ROLES[m[1]] if m[1] else unquote(m[2]), unescape(body)))
        at = m.end()
    return turns


def render(role: str | None, text: str | None) -> tuple[str, str, int]:
    """(rendered turn, text read back, escapings needed) of one turn."""
    role, text = role or "", text or ""
    before, after = open_close(role)
    body = text
    for tries in range(3):
        out = before + body + after
        got = parse(out)
        if got == [(role, text)]:
            return out, got[0][1], tries
        body = escape(text)
    raise ValueError("a turn does not survive its rendering")


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, rendered, recovered, escapings): every turn rendered and read back. Joined
    in order of turn (then role, text), ``rendered`` is the formatted conversation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles = [r or "" for r in batch.column(2).to_pylist()]
            done = [render(r, t.as_py()) for r, t in zip(roles, batch.column(3))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(roles, pa.string()), pa.array([d[0] for d in done], pa.string()),
                 pa.array([d[1] for d in done], pa.string()), pa.array([d[2] for d in done], pa.int32())],
                ["conv_id", "turn", "role", "rendered", "recovered", "escapings"])

    four = shipped(turns).select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text")
    return four.mapInArrow(run, "conv_id bigint, turn bigint, role string, rendered string, recovered string, escapings int")


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, from its rendered turns read back in order: n_turns, turns_sha256, loss_chars,
    loss_sha256 (text under the loss mask: each assistant text), formatted_chars."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, done = None, None, []

        def close():
            n, turns, loss_chars, loss, chars = state
            return (conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars)

        def out(rows):
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for this, rendered in zip(batch.column(0).to_pylist(), batch.column(1)):
                rendered = rendered.as_py()
                if state is None or this != conv:
                    if state:
                        done.append(close())
                    conv, state = this, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                (role, text), = parse(rendered)
                raw = text.encode("utf-8", "surrogatepass")
                state[0] += 1
                state[1].update(role.encode("utf-8", "surrogatepass") + b"\n" + raw + b"\n")
                if role == LOSS_ROLE:
                    state[2] += len(text)
                    state[3].update(raw)
                state[4] += len(rendered)
                if len(done) >= 4096:
                    yield out(done)
                    done = []
        if state:
            done.append(close())
        if done:
            yield out(done)

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "recovered")
    return ordered.select("conv_id", "rendered").mapInArrow(
        run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
