"""Chat formatting: a finite-state machine over roles, a declarative template.

Turns arrive per conversation in order and stream through their task one by
one, so a conversation of any length needs bounded memory. The machine's state is the last
role; a turn or an end that the transitions do not allow marks the
conversation invalid with the first reason, and it is formatted all the same. A
turn becomes three segments (opening mark, text, closing mark), each with a
loss flag; only the texts of ``learned`` roles carry loss. Control strings inside
texts are escaped reversibly, so the formatted text can be parsed back.

Defined results: null text is empty; a null role is the role ''; turns with
equal or null numbers are ordered by role and text, null numbers first; a null
conversation id is a conversation of its own; repeated rows are repeated
turns; an empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``marks``: role -> (opening, closing); other roles use ``other``, whose
    opening names the role. ``control``: strings that texts must not contain
    unescaped. ``allowed``: state -> next roles; ``final``: states that may end."""

    marks: dict = field(default_factory=lambda: {
        "system": ("<<SYS>>\n", "\n<</SYS>>\n"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>\n")})
    other: tuple = ("<turn>{role}</turn> ", " <end>\n")
    control: tuple = ("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "<turn>", "</turn>", "<end>")
    allowed: dict = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple = ("assistant",)
    learned: tuple = ("assistant",)

    def escape(self, text: str) -> str:
        r"""``\`` becomes ``\\``; a control string gets a ``\`` after its first character."""
        strings = "|".join(map(re.escape, self.control))
        return re.sub(strings, lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        opening, closing = self.marks.get(role) or (self.other[0].replace("{role}", self.escape(role)), self.other[1])
        return [(opening, False), (self.escape(text), role in self.learned), (closing, False)]

    def parse(self, formatted: str) -> Iterator[tuple[str, str, int]]:
        """(role, text, place of the escaped text) of each turn."""
        ways = [(r, re.escape(a), re.escape(b)) for r, (a, b) in self.marks.items()]
        named = re.escape(self.other[0]).replace(re.escape("{role}"), "(?P<role>.*?)")
        turn = re.compile("|".join([f"{a}(?P<t{k}>.*?){b}" for k, (_, a, b) in enumerate(ways)]
                                   + [f"{named}(?P<rest>.*?){re.escape(self.other[1])}"]), re.DOTALL)
        at = 0
        while at < len(formatted):
            m = turn.match(formatted, at)
            if not m:
                raise ValueError(f"not a turn at {at}")
            name = m.lastgroup
            role = ways[int(name[1:])][0] if name != "rest" else self.unescape(m["role"])
            yield role, self.unescape(m[name]), m.start(name)
            at = m.end()

    def step(self, state: str, role: str) -> str | None:
        """The reason why ``role`` may not follow ``state``, or None."""
        return None if role in self.allowed.get(state, ()) else f"{role} after {state}"


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 500) -> Iterator[pa.RecordBatch]:
    part: list[tuple] = []
    for row in rows:
        part.append(row)
        if len(part) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*part), schema, strict=True)], schema=schema)
            part = []
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*part), schema, strict=True)], schema=schema)


SEGMENT = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("loss", pa.bool_())])


def format_turns(conversations: DataFrame, template: Template = Template(), conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per turn: conv_id, place (0, 1, ...), formatted, segments
    (start, length, loss in ``formatted``), problem (null, or why the machine
    refuses the turn). A conversation's formatted text is its rows in order of place."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select(F.col(conv_col).cast("long").alias("conv"), text(role_col).alias("role"), text(text_col).alias("text"),
                                F.col(turn_col).alias("turn"))
    rows = rows.repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text").drop("turn")
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("formatted", pa.string()),
                        ("segments", pa.list_(SEGMENT)), ("problem", pa.string())])

    def run(batches):
        def made():
            conv, place, state = None, -1, ""
            for c, role, said in _turns(batches):
                if place < 0 or c != conv:
                    conv, place, state = c, -1, "start"
                place += 1
                parts, at, spans = template.segments(role, said), 0, []
                for part, loss in parts:
                    spans.append({"start": at, "length": len(part), "loss": loss})
                    at += len(part)
                yield c, place, "".join(p for p, _ in parts), spans, template.step(state, role)
                state = role
        yield from _batched(made(), schema)

    return rows.mapInArrow(run, "conv_id long, place long, formatted string, "
                                "segments array<struct<start:long,length:long,loss:boolean>>, problem string")


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Digests per conversation from formatted rows alone: the text is parsed
    back into turns and the loss mask read off the segments."""
    rows = formatted.select("conv_id", "formatted", "segments", "problem", "place").repartition("conv_id") \
        .sortWithinPartitions("conv_id", "place").drop("place")
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("problem", pa.string())])

    def run(batches):
        def made():
            conv, own = None, None
            for c, chunk, spans, problem in _turns(batches):
                if own is None or c != conv:
                    if own:
                        yield finished(conv, own)
                    conv, own = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, None, "start"]
                for role, text, _ in template.parse(chunk):
                    own[0] += 1
                    own[1].update(f"{role}\n{text}\n".encode())
                    own[6] = role
                for s in spans:
                    if s["loss"]:
                        text = template.unescape(chunk[s["start"]:s["start"] + s["length"]])
                        own[2] += len(text)
                        own[3].update(text.encode())
                own[4] += len(chunk)
                own[5] = own[5] or problem
            if own:
                yield finished(conv, own)

        def finished(conv, own):
            ends = None if own[6] in template.final else f"ends after {own[6]}"
            return conv, own[0], own[1].hexdigest(), own[2], own[3].hexdigest(), own[4], own[5] or ends
        yield from _batched(made(), schema)

    out = rows.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                               "formatted_chars long, problem string")
    return out.withColumn("valid", F.col("problem").isNull())
