"""Chat formatting by a finite-state machine over roles and a declarative template.

A ``Template`` names the roles, what opens and closes a turn of each, which roles' texts carry
loss, and which role may follow which state. ``format_turns`` emits the segments of every turn
with their loss flags: column expressions over single rows, in any partitioning. The machine
reads the formatted text back: ``read_back`` splits it at the marks, undoes the escapes and
steps through the roles, whose faults are counted, not dropped.

Escapes. Every control string begins with ``<`` or ``[`` and has neither elsewhere. In a text
a control string, or one with backslashes after its first character, gets one backslash more
there; reading back takes one away. So no text holds a control string, and the way back is
unique.

Conversations of any length. Rows are dealt by ranges of (conversation, turn), so a
conversation that holds most rows is spread over tasks. A task digests the conversations that
lie inside its range; of the first and the last one, which may go on elsewhere, it passes on
joined texts and the machine's map from state to state, and one more step puts these pieces
together in order, streaming, with one running digest per conversation.

Defined results: a NULL text is empty, a NULL role is the empty role; any other role than the
template's is written with its name and counts as a fault; rows of a conversation are ordered
by turn (NULL first), then by their formatted text; equal rows are turns of their own; rows
with NULL conversation form one conversation; texts are read whole; other columns are kept by
``format_turns`` (one named ``segments`` is replaced) and ignored by ``read_back``; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from diamondlake.operators.materialize import materialize


@dataclass(frozen=True)
class Turn:
    """Marks around a role's text, and whether the text carries loss."""

    role: str
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Turns by role, marks of any other role, and the machine: state -> role -> state.

    A state is named like the role that led to it, ``start`` apart; a role that may not follow
    is a fault and leads to its own state all the same.
    """

    turns: tuple[Turn, ...]
    other: tuple[str, str, str]
    follows: dict[str, tuple[str, ...]]
    accepting: tuple[str, ...]
    start: str = "start"
    states: tuple[str, ...] = field(init=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "states", (self.start, *(t.role for t in self.turns), "other"))
        for mark in self.control:
            if not re.fullmatch(r"[<\[][^<\[\\]+", mark):
                raise ValueError(f"a control string begins with < or [ and has none of < [ \\ elsewhere: {mark!r}")

    @property
    def control(self) -> list[str]:
        """Control strings, longest first: the marks without the blanks around them."""
        marks = [m for t in self.turns for m in (t.open, t.close)] + list(self.other)
        return sorted({c for m in marks for c in [m.strip()] if c}, key=lambda c: (-len(c), c))

    def step(self, state: str, role: str) -> tuple[str, bool]:
        """(next state, whether the role was allowed)."""
        known = role if role in self.states[1:-1] else "other"
        return known, known in self.follows.get(state, ())


#: Instruction template: the answer stands bare between the instruction's end and the end mark.
INSTRUCT = Template(
    turns=(Turn("system", "[SYS] ", " [/SYS]"), Turn("user", "[INST] ", " [/INST]"), Turn("assistant", " ", "</s>", loss=True)),
    other=("[ROLE] ", " [TEXT] ", " [/TEXT]"),
    follows={"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    accepting=("assistant",),
)


# ---- writing --------------------------------------------------------------------------------


def _tails(template: Template) -> dict[str, list[str]]:
    tails: dict[str, list[str]] = {}
    for mark in template.control:
        tails.setdefault(mark[0], []).append(mark[1:])
    return tails


def _patterns(template: Template, backslashes: str) -> list[str]:
    """For each first character: it, backslashes, and what completes a control string."""
    return [rf"({re.escape(head)})({backslashes})(?={'|'.join(re.escape(t) for t in tails)})" for head, tails in _tails(template).items()]


def escaped(text: Column, template: Template) -> Column:
    for pattern in _patterns(template, r"\\*"):
        text = F.regexp_replace(text, pattern, r"$1\\$2")
    return text


def format_turns(conversations: DataFrame, template: Template = INSTRUCT, role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conversations`` with ``segments``: (text, loss) of every turn, in order; their texts joined are the formatted turn."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), escaped(F.coalesce(F.col(text_col), F.lit("")), template)

    def segments(parts: list[tuple[Column, bool]]) -> Column:
        return F.array(*[F.struct(t.alias("text"), F.lit(loss).alias("loss")) for t, loss in parts])

    start, middle, end = (F.lit(m) for m in template.other)
    plain = segments([(start, False), (escaped(role, template), False), (middle, False), (text, False), (end, False)])
    for turn in template.turns:
        own = segments([(F.lit(turn.open), False), (text, turn.loss), (F.lit(turn.close), False)])
        plain = F.when(role == turn.role, own).otherwise(plain)
    return conversations.withColumn("segments", plain)


# ---- reading back -----------------------------------------------------------------------------


class Reader:
    """Splits formatted text at the control strings."""

    def __init__(self, template: Template):
        self.template = template
        self.marks = re.compile("|".join(re.escape(c) for c in template.control))
        self.escapes = [re.compile(p) for p in _patterns(template, r"\\+")]
        self.by_mark = {t.open.strip(): t for t in template.turns if t.open.strip()}
        self.bare = [t for t in template.turns if not t.open.strip()]

    def plain(self, text: str) -> str:
        if "\\" not in text:
            return text
        for pattern in self.escapes:
            text = pattern.sub(lambda m: m[1] + m[2][1:], text)
        return text

    def turns(self, formatted: str) -> Iterator[tuple[str, int, int]]:
        """(role, start and stop of the text) of every turn of a formatted text."""
        at = 0
        while at < len(formatted):
            mark = self.marks.match(formatted, at)
            if mark is None:
                turn = self.bare[0]
            elif mark[0] == self.template.other[0].strip():
                _, middle, end = self.template.other
                split = formatted.index(middle, mark.end())
                stop = formatted.index(end, split + len(middle))
                yield self.plain(formatted[at + len(self.template.other[0]) : split]), split + len(middle), stop
                at = stop + len(end)
                continue
            else:
                turn = self.by_mark[mark[0]]
            stop = formatted.index(turn.close, at + len(turn.open))
            yield turn.role, at + len(turn.open), stop
            at = stop + len(turn.close)


class Reading:
    """What the machine knows of a stretch of one conversation, read from formatted turns."""

    def __init__(self, template: Template, reader: Reader, entries: tuple[str, ...]):
        self.template, self.reader = template, reader
        self.n_turns = self.formatted_chars = self.loss_chars = 0
        self.turn_bytes: list[bytes] = []
        self.loss_bytes: list[bytes] = []
        #: From every state the stretch may begin in: state now, faults so far, first fault's turn.
        self.now = {s: (s, 0, None) for s in entries}

    def add(self, formatted: str, lengths: list[int], flags: list[bool]) -> None:
        plain, start = self.reader.plain, 0
        self.formatted_chars += len(formatted)
        for role, low, high in self.reader.turns(formatted):
            self.turn_bytes.append(f"{role}\n{plain(formatted[low:high])}\n".encode())
            for entry, (state, faults, first) in self.now.items():
                after, allowed = self.template.step(state, role)
                self.now[entry] = (after, faults + (not allowed), self.n_turns if first is None and not allowed else first)
            self.n_turns += 1
        for length, loss in zip(lengths, flags):
            if loss:
                text = plain(formatted[start : start + length])
                self.loss_chars += len(text)
                self.loss_bytes.append(text.encode())
            start += length


_SIZES = [("n_turns", pa.int64()), ("loss_chars", pa.int64()), ("formatted_chars", pa.int64())]
_DIGESTS = [("turns_sha256", pa.string()), ("loss_sha256", pa.string())]
_MACHINE = [("n_faults", pa.int64()), ("first_fault", pa.int64()), ("complete", pa.bool_())]
_STATE = pa.struct([("now", pa.string()), ("faults", pa.int64()), ("first", pa.int64())])
_ANSWERS = pa.schema([("conv", pa.int64()), *_SIZES, *_DIGESTS, *_MACHINE])
_PIECES = pa.schema([
    *_ANSWERS, ("part", pa.int64()), ("piece", pa.int64()), ("turn_bytes", pa.binary()), ("loss_bytes", pa.binary()), ("map", pa.list_(_STATE)),
])
ANSWERS = (
    "conv long, n_turns long, loss_chars long, formatted_chars long, turns_sha256 string, loss_sha256 string,"
    " n_faults long, first_fault long, complete boolean"
)
PIECES = f"{ANSWERS}, part long, piece long, turn_bytes binary, loss_bytes binary, map array<struct<now: string, faults: long, first: long>>"
#: Characters of one conversation that a task holds before it passes them on as a piece.
PIECE_CHARS = 1_000_000


def read_back(formatted: DataFrame, template: Template = INSTRUCT, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """One row per conversation, told from ``segments`` alone: sizes, digests, and what the machine says.

    ``turns_sha256`` covers role, line feed, text, line feed of every turn, ``loss_sha256`` all text
    under the loss mask; ``first_fault`` is the number of the first turn the machine did not allow,
    ``complete`` whether it ended where a conversation may end.
    """
    rows = formatted.select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        F.transform("segments", lambda s: F.length(s["text"])).alias("lengths"),
        F.transform("segments", lambda s: s["loss"]).alias("flags"),
    ).withColumn("head", F.substring("formatted", 1, 64))
    dealt = rows.repartitionByRange("conv", "turn", "head").sortWithinPartitions("conv", "turn", "head", "formatted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, part, pieces = Reader(template), TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        # The first conversation may have begun in an earlier range, the last may go on in a later one.
        conv, begun, chars, shared = None, False, 0, True

        def settled() -> dict:
            nonlocal pieces
            read = Reading(template, reader, template.states if shared else (template.start,))
            for one in held:
                read.add(*one)
            held.clear()
            pieces += shared
            return {"conv": conv, **(_piece(read, part, pieces) if shared else _answer(read))}

        for batch in batches:
            out = []
            for key, text, lengths, flags in zip(*(batch.column(c).to_pylist() for c in ("conv", "formatted", "lengths", "flags"))):
                if begun and key != conv:
                    if held:
                        out.append(settled())
                    chars, shared = 0, False
                conv, begun = key, True
                held.append((text, lengths, flags))
                chars += len(text)
                if chars >= PIECE_CHARS:
                    shared, chars = True, 0
                    out.append(settled())
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_PIECES)
        if held:
            shared = True
            yield pa.RecordBatch.from_pylist([settled()], schema=_PIECES)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: Chain | None = None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if whole is None or row["conv"] != whole.conv:
                    if whole is not None:
                        out.append(whole.answer())
                    whole = Chain(row["conv"], template)
                whole.add(row)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_ANSWERS)
        if whole is not None:
            yield pa.RecordBatch.from_pylist([whole.answer()], schema=_ANSWERS)

    found = materialize(dealt.mapInArrow(run, PIECES))
    whole = found.where("part IS NULL").select(*_ANSWERS.names)
    parts = found.where("part IS NOT NULL").repartition("conv").sortWithinPartitions("conv", "part", "piece")
    return whole.unionByName(parts.mapInArrow(together, ANSWERS)).withColumnRenamed("conv", conv_col)


def _machine(template: Template, state: str, faults: int, first: int | None) -> dict:
    return {"n_faults": faults, "first_fault": first, "complete": state in template.accepting}


def _answer(read: Reading) -> dict:
    """A conversation that lies in one task."""
    sizes = {name: getattr(read, name) for name, _ in _SIZES}
    turns, loss = (hashlib.sha256(b"".join(b)).hexdigest() for b in (read.turn_bytes, read.loss_bytes))
    return {**sizes, "turns_sha256": turns, "loss_sha256": loss, **_machine(read.template, *read.now[read.template.start])}


def _piece(read: Reading, part: int, piece: int) -> dict:
    """A stretch of a conversation that goes on elsewhere."""
    states = [dict(zip(("now", "faults", "first"), read.now[s])) for s in read.template.states]
    sizes = {name: getattr(read, name) for name, _ in _SIZES}
    return {**sizes, "part": part, "piece": piece, "turn_bytes": b"".join(read.turn_bytes), "loss_bytes": b"".join(read.loss_bytes), "map": states}


class Chain:
    """A conversation put together from its pieces in order; holds digests, not texts."""

    def __init__(self, conv: int | None, template: Template):
        self.conv, self.template = conv, template
        self.sizes = {name: 0 for name, _ in _SIZES}
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.state, self.faults, self.first = template.start, 0, None

    def add(self, row: dict) -> None:
        after = row["map"][self.template.states.index(self.state)]
        if self.first is None and after["first"] is not None:
            self.first = self.sizes["n_turns"] + after["first"]
        self.state, self.faults = after["now"], self.faults + after["faults"]
        for name in self.sizes:
            self.sizes[name] += row[name]
        self.turns.update(row["turn_bytes"])
        self.loss.update(row["loss_bytes"])

    def answer(self) -> dict:
        return {"conv": self.conv, **self.sizes, "turns_sha256": self.turns.hexdigest(), "loss_sha256": self.loss.hexdigest(),
                **_machine(self.template, self.state, self.faults, self.first)}
