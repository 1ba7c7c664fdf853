r"""Chat formatting with a grammar round trip.

The rendered form of a conversation is the concatenation of its turns::

    turn    := "### " label ": " body "</turn>" "\n"
    label   := "User" | "Assistant" | "System" | "role=" body
    body    := (any text without control strings | escape)*
    control := "### " | "</turn>" | an escape
    escape  := "\" before a control string or before another "\"

A turn is first rendered as it is and read again by the parser below. If what comes back is not
exactly that turn, the content that conflicts with the grammar is escaped and the result is
read again; only a rendering that reads back identically is let out. Since every turn ends in
the parser's start state, turns can be rendered apart and their concatenation parses turn by
turn. Most texts contain no control string and stay as they are.

How it runs: rendering and its round trip go row by row where the rows lie. The digests of a
conversation are sequential by definition, so its rendered turns are dealt by conversation and
sorted inside the partition by Spark, and one stream reads them back through the parser with
two running hashes: no conversation is ever held as a whole, however many turns it has.

Nulls: a null text or role is the empty string, a null turn sorts first, rows with a null
conversation id form one conversation. Turns that share a number are ordered by role and text;
repeated rows are turns of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABELS = {"user": "User", "assistant": "Assistant", "system": "System"}
_ROLES = {v: k for k, v in LABELS.items()}
_OPEN, _CLOSE = "### ", "</turn>"
_TOKEN = re.compile(r"\\(\\|### |</turn>)|(### )|(</turn>)")
_CONTROL = re.compile(r"(\\|### |</turn>)")


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\1", text)


def parse(rendered: str) -> tuple[list[tuple[str, str]], bool]:
    """The turns of a rendered text, and whether all of it followed the grammar.

    Deterministic and in one pass: outside of a turn only an opening may follow, inside of one a
    close ends it; an opening inside of a turn, or anything between turns, breaks the grammar.
    """
    turns, at = [], 0
    while at < len(rendered):
        if not rendered.startswith(_OPEN, at):
            return turns, False
        colon, label = rendered.find(": ", at), None
        if rendered.startswith("role=", at + len(_OPEN)):
            label, colon = _body(rendered, at + len(_OPEN) + 5, ": ")
        elif colon >= 0:
            label = _ROLES.get(rendered[at + len(_OPEN) : colon])
        if label is None:
            return turns, False
        text, at = _body(rendered, colon + 2, _CLOSE)
        if text is None or not rendered.startswith("\n", at + len(_CLOSE)):
            return turns, False
        turns.append((label, text))
        at += len(_CLOSE) + 1
    return turns, True


def _body(rendered: str, at: int, end: str) -> tuple[str | None, int]:
    """Unescaped text from ``at`` to the first unescaped ``end``, and where that stands."""
    parts, token = [], _TOKEN if end == _CLOSE else _LABEL_TOKEN
    while m := token.search(rendered, at):
        parts.append(rendered[at : m.start()])
        if m[1] is None:
            return ("".join(parts), m.start()) if m[0] == end else (None, m.start())
        parts.append(m[1])
        at = m.end()
    return None, len(rendered)


_LABEL_TOKEN = re.compile(r"\\(\\|: |### |</turn>)|(: )|(### |</turn>)")
_LABEL_CONTROL = re.compile(r"(\\|: |### |</turn>)")


def render(role: str, text: str) -> str:
    """The turn in the grammar; what is returned has been read back and found identical."""
    label = LABELS.get(role) or "role=" + _LABEL_CONTROL.sub(r"\\\1", role)
    for body in (lambda: text, lambda: escape(text)):
        out = f"{_OPEN}{label}: {body()}{_CLOSE}\n"
        if parse(out) == ([(role, text)], True):
            return out
    raise ValueError("a turn does not survive its round trip")


def render_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, rendered), a row for each turn."""
    rows = turns.select(F.col(conv).alias("_c"), F.col(turn).alias("_t"), F.coalesce(F.col(role), F.lit("")).alias("_r"), F.coalesce(F.col(text), F.lit("")).alias("_x"))
    kinds = [rows.schema[c].dataType.simpleString() for c in ("_c", "_t")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [render(r, x) for r, x in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], names=["_c", "_t", "rendered"])

    return rows.mapInArrow(run, f"_c {kinds[0]}, _t {kinds[1]}, rendered string").toDF(conv, turn, "rendered")


def conversation_digests(rendered: DataFrame, conv: str = "conv_id", turn: str = "turn", learned: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Per conversation, read back from its rendered turns: turns and text under the loss mask, as counts and digests."""
    kind = rendered.schema[conv].dataType.simpleString()
    rows = rendered.repartition(conv).sortWithinPartitions(F.col(conv), F.col(turn).asc_nulls_first(), "rendered").select(conv, "rendered")
    names = ["_c", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for b in batches:
            done = []
            for c, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if state is None or state[0] != c:
                    done += [state] if state else []
                    state = [c, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                found, whole = parse(text)
                if not whole:
                    raise ValueError("a rendered turn is broken")
                for role, body in found:
                    state[1] += 1
                    state[2].update(f"{role}\n{body}\n".encode())
                    if role in learned:
                        state[3] += len(body)
                        state[4].update(body.encode())
                state[5] += len(text)
            if done:
                yield packed(done, b.schema.field(0).type)
            last = b.schema.field(0).type
        if state:
            yield packed([state], last)

    def packed(states, kind):
        cols = list(zip(*[(c, n, t.hexdigest(), k, x.hexdigest(), f) for c, n, t, k, x, f in states], strict=True))
        return pa.RecordBatch.from_arrays([pa.array(v, kind if i == 0 else pa.string() if i in (2, 4) else pa.int64()) for i, v in enumerate(cols)], names=names)

    return rows.mapInArrow(run, f"_c {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long").withColumnRenamed("_c", conv)


def format_conversations(turns: DataFrame, **columns) -> DataFrame:
    """(conv, formatted): each conversation as one text, for conversations of ordinary length."""
    conv, turn = columns.get("conv", "conv_id"), columns.get("turn", "turn")
    rows = render_turns(turns, **columns).groupBy(conv).agg(F.sort_array(F.collect_list(F.struct(turn, "rendered"))).alias("_all"))
    return rows.select(conv, F.array_join(F.transform("_all", lambda x: x["rendered"]), "").alias("formatted"))


def op1(conversations: DataFrame) -> DataFrame:
    spark, said = conversations.sparkSession, r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = conversations.select("conv_id", "turn", "role", "text").union(extra)
    return conversation_digests(render_turns(rows))


#: The same digests straight from the turns, and the rendered length from the grammar's rules.
ORACLE = r"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
r as (select *, case role when 'user' then 'User' when 'assistant' then 'Assistant' when 'system' then 'System'
    else 'role=' || regexp_replace(role, '(\\|: |### |</turn>)', '\\\1', 'g') end as label,
  case when regexp_matches(text, '\\\\|### |</turn>|\\$') then regexp_replace(text, '(\\|### |</turn>)', '\\\1', 'g') else text end as body from t)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, '### ' || label || ': ' || body)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, '### ' || label || ': ' || body) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(length(label) + length(body) + 14) as bigint) as formatted_chars
from r group by conv_id
"""
