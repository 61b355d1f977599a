"""Chat formatting by grammar round trip.

A conversation is rendered as ``<s>`` and one marked section a turn::

    system     [SYS]text[/SYS]
    user       [INST]text[/INST]
    assistant  [ANS]text</s>
    any other  [ROLE]role[TEXT]text[/ROLE]

The rendered text is parsed again by a deterministic parser and the recovered turns are compared with the
source. Where they differ, the turns that don't survive on their own are escaped, until the recovered turns
are identical. Escaping is reversible: k backslashes before a control string become 2k + 1, a run of k
backslashes at the end of a text becomes 2k. The parser reads an odd run as escaped text, an even run as
text followed by a real control.

The loss mask covers the text of assistant turns: ``loss_spans`` are code point ranges of the formatted
text, ``loss`` is what stands under them, unescaped.

Defined results: a null text or role is the empty string (an empty role is an "other" role); turns are
ordered by turn number, nulls first, then by role and text; repeated rows are repeated turns; a null
conv_id is a conversation of its own; no rows give no rows. A conversation is one output value, so it is
put together in one task; different conversations never meet in one.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pvspark.llm.common import small_batches

MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[ANS]", "</s>")}
OTHER = ("[ROLE]", "[TEXT]", "[/ROLE]")
BEGIN = "<s>"
CONTROLS = [BEGIN, *(m for pair in MARKS.values() for m in pair), *OTHER]
_CONTROL = "|".join(map(re.escape, CONTROLS))
_TOKEN = re.compile(rf"(\\*)({_CONTROL})")
_KIND = {pair[0]: role for role, pair in MARKS.items()}

SCHEMA = ("conv_id long, formatted string, turns array<struct<role:string,text:string>>, "
          "loss_spans array<struct<start:int,stop:int>>, loss array<string>")


def escape(text: str) -> str:
    text = _TOKEN.sub(lambda m: m[1] * 2 + "\\" + m[2], text)
    tail = len(text) - len(text.rstrip("\\"))
    return text + "\\" * tail


def render(turns: list[tuple[str, str]], escaped: list[bool]) -> str:
    out = [BEGIN]
    for (role, text), esc in zip(turns, escaped, strict=True):
        put = escape if esc else str
        if role in MARKS:
            out += [MARKS[role][0], put(text), MARKS[role][1]]
        else:
            out += [OTHER[0], put(role), OTHER[1], put(text), OTHER[2]]
    return "".join(out)


def parse(formatted: str) -> list[tuple[str, str, int, int]] | None:
    """(role, text, start, stop) of each turn, start and stop being those of the escaped text; or None."""
    expect, role, out = BEGIN, "", []
    literal: list[str] = []
    at = start = 0
    for m in _TOKEN.finditer(formatted):
        literal.append(formatted[at:m.start()])
        run, control = len(m[1]), m[2]
        literal.append("\\" * (run // 2))
        at = m.end()
        if run % 2:
            literal.append(control)
            continue
        text, stop = "".join(literal), m.start(2)
        literal = []
        if expect is None:                                   # between turns
            if text or control not in (*_KIND, OTHER[0]):
                return None
            role = _KIND.get(control, "")
            expect = MARKS[role][1] if control in _KIND else OTHER[1]
        elif control != expect:
            return None
        elif control == BEGIN:
            if text:
                return None
            expect = None
        elif control == OTHER[1]:
            role, expect = text, OTHER[2]
        else:
            out.append((role, text, start, stop))
            expect = None
        start = at
    return out if expect is None and at == len(formatted) and not literal else None


def _unescape(text: str) -> str:
    """Text of one span; at its end stands a control, so a run of backslashes there counts as before one."""
    text = _TOKEN.sub(lambda m: "\\" * (len(m[1]) // 2) + m[2], text)
    bare = text.rstrip("\\")
    return bare + "\\" * ((len(text) - len(bare)) // 2)


def round_trip(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[str, str, int, int]]]:
    """The formatted conversation and its parse, identical to ``turns``."""
    escaped = [False] * len(turns)
    while True:
        formatted = render(turns, escaped)
        got = parse(formatted)
        if got is not None and [t[:2] for t in got] == turns:
            return formatted, got
        changed = False
        for i, turn in enumerate(turns):
            if not escaped[i]:
                alone = parse(render([turn], [False]))
                if alone is None or [t[:2] for t in alone] != [turn]:
                    escaped[i] = changed = True
        if not changed:
            raise ValueError("turns that survive alone do not survive together")


def _format_batches(batches):
    for batch in batches:
        rows = []
        for conv_id, turns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            formatted, got = round_trip([(t["role"] or "", t["text"] or "") for t in turns])
            spans = [(a, b) for role, _, a, b in got if role == "assistant"]
            rows.append((conv_id, formatted, [{"role": t[0], "text": t[1]} for t in got],
                         [{"start": a, "stop": b} for a, b in spans],
                         [_unescape(formatted[a:b]) for a, b in spans]))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
        turn = pa.struct([("role", pa.string()), ("text", pa.string())])
        span = pa.struct([("start", pa.int32()), ("stop", pa.int32())])
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.list_(turn)),
             pa.array(cols[3], pa.list_(span)), pa.array(cols[4], pa.list_(pa.string()))],
            ["conv_id", "formatted", "turns", "loss_spans", "loss"])


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (read back), loss_spans, loss: one row per conversation."""
    small_batches(conversations.sparkSession)
    grouped = (conversations
               .select(F.col("conv_id").cast("bigint").alias("conv_id"),
                       F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                                F.coalesce("text", F.lit("")).alias("text")).alias("t"))
               .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))
    return grouped.mapInArrow(_format_batches, SCHEMA)
