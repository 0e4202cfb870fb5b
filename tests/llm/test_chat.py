"""Chat formatting: round trips, the machine, conversations over several tasks."""

import hashlib

import pytest
from pyspark.sql import functions as F

from diamondlake.llm import chat_template
from diamondlake.llm.chat_template import INSTRUCT, Reader, Template, Turn, format_turns, read_back

SCHEMA = "conv_id long, turn long, role string, text string, segments string, conv long, formatted string"
TRICKY = [
    None, "", "</s>", "[INST] ok [/INST]", r"<\/s> <\\/s> [\INST] [\\/INST]", "<</s>", "[[SYS]", "x [/INST", "\\", "[", "<\\", "naïve 你好 </s",
    "[TEXT] a [/TEXT] [ROLE] b", " [/INST]", "\n\n", "[/SYS]\\</s>\\", "a" * 3000,
]


def rows_of(extra=()):
    rows = []
    for i, text in enumerate(TRICKY):
        rows += [(i, 0, "user", text), (i, 1, "assistant", text), (i, 2, "user", text)]
    rows += [(100, 0, "system", "s"), (100, 1, "user", "u"), (100, 2, "assistant", "a"), (100, 3, "assistant", "b"), (100, 3, "assistant", "b")]
    rows += [(101, None, "tool[/ROLE]", "[INST]"), (101, 1, None, None), (101, 2, "[TEXT]", " [TEXT] "), (101, 3, "", "x")]
    rows += [(None, 1, "user", "no id"), (None, 2, "assistant", "none"), (102, 0, "assistant", "first")]
    return [*rows, *extra]


def plain(rows):
    """conv -> what reading back must give, straight from the rows."""
    out = {}
    for conv in {r[0] for r in rows}:
        state, faults, first, turns, loss = "start", 0, None, b"", ""
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[3] or ""))
        for n, (_, _, role, text) in enumerate(own):
            role, text = role or "", text or ""
            after = role if role in ("system", "user", "assistant") else "other"
            if after not in INSTRUCT.follows.get(state, ()):
                faults, first = faults + 1, n if first is None else first
            state = after
            turns += f"{role}\n{text}\n".encode()
            loss += text if role == "assistant" else ""
        out[conv] = (len(own), hashlib.sha256(turns).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), faults, first, state == "assistant")
    return out


def answers(frame):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"], r["n_faults"], r["first_fault"], r["complete"])
            for r in frame.collect()}


@pytest.mark.parametrize("chars", [1_000_000, 5])
def test_round_trip(spark, monkeypatch, chars):
    """Every odd text and role comes back, also when every turn is a piece of its own."""
    monkeypatch.setattr(chat_template, "PIECE_CHARS", chars)
    rows = rows_of()
    frame = spark.createDataFrame([(*r, "x", 7, "y") for r in rows], SCHEMA).repartition(5)
    formatted = format_turns(frame)
    assert set(formatted.columns) == set(frame.columns)
    assert answers(read_back(formatted)) == plain(rows)
    for r in formatted.select("text", "role", F.expr("filter(segments, s -> s.text = text)").alias("same")).collect():
        if r["text"] == "</s>":
            assert not r["same"] or r["role"] == "assistant"  # only the closing mark, never the text


def test_long_conversation(spark):
    """A conversation of most rows lies in several tasks and is digested in order."""
    rows = rows_of([(55, n, "user" if n % 2 == 0 else "assistant", f"text {n} </s>" * (n % 7)) for n in range(3000)])
    frame = spark.createDataFrame([(*r, "x", 7, "y") for r in rows], SCHEMA).repartition(7)
    got = read_back(format_turns(frame))
    assert answers(got) == plain(rows)
    assert got.where("conv_id = 55").first()["formatted_chars"] == format_turns(frame).where("conv_id = 55").select(
        F.sum(F.length(F.array_join(F.transform("segments", lambda s: s["text"]), "")))).first()[0]


def test_no_rows(spark):
    assert read_back(format_turns(spark.createDataFrame([], SCHEMA))).count() == 0


def test_template_of_other_marks(spark):
    """Another template, with loss on two roles; marks that could not be told apart are refused."""
    both = Template((Turn("q", "<q>", "</q>", True), Turn("a", "<a>", "</a>", True)), ("[o]", "[t]", "[/t]"), {"start": ("q",), "q": ("a",), "a": ("q",)}, ("a",))
    frame = spark.createDataFrame([(1, 1, "q", "<q>x</q>"), (1, 2, "a", "</a>"), (1, 3, "z", "<a>[t]")], "conv_id long, turn long, role string, text string")
    (row,) = read_back(format_turns(frame, both), both).collect()
    assert row["loss_sha256"] == hashlib.sha256(b"<q>x</q></a>").hexdigest() and row["n_faults"] == 1 and not row["complete"]
    assert row["turns_sha256"] == hashlib.sha256(b"q\n<q>x</q>\na\n</a>\nz\n<a>[t]\n").hexdigest()
    with pytest.raises(ValueError):
        Template((Turn("q", "<<q>", "</q>"),), ("[o]", "[t]", "[/t]"), {}, ())


def test_texts_hold_no_control_string(spark):
    reader = Reader(INSTRUCT)
    frame = spark.createDataFrame([(t or "",) for t in TRICKY], "text string")
    for r in frame.select("text", chat_template.escaped(F.col("text"), INSTRUCT).alias("safe")).collect():
        assert not reader.marks.search(r["safe"]) and reader.plain(r["safe"]) == r["text"]
