"""Chat formatting against a plain version: escapes, order of turns, conversations in several blocks, edge rows."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dealerlake.llm import chat
from dealerlake.llm.chat import BRACKETS, ROLE, TEXT, Template, format_chats, read_back

MOVES = {("start", "system"), ("start", "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user")}
SCHEMA = "conv_id long, turn long, role string, text string"
ROWS = [
    (1, 0, "system", "be kind"),
    (1, 1, "user", "[INST] hi [\\INST] [/INST]"),
    (1, 2, "assistant", "<s></s><\\s>"),
    (1, 2, "assistant", "<s></s><\\s>"),  # a repeated row
    (2, 5, "assistant", "who asks?"),
    (2, None, "user", None),
    (2, 9, None, "no role"),
    (2, 10, "tool[SAYS]", "x [ROLE] \\"),
    (2, 11, "assistant", ""),
    (None, 0, "user", "no id"),
    (None, 1, "assistant", "none"),
    (3, -5, "user", "naïve 中文 \n\t"),
    (4, 0, "user", "<" + "[INST]" * 50_000),
]


def plain(rows):
    """What each conversation comes to, from its rows in order."""
    out, by = {}, {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for conv, turns in by.items():
        state, invalid = "start", 0
        for _, _, role, _ in sorted(turns):
            invalid += (state, role) not in MOVES
            state = role if role in ("system", "user", "assistant") else state
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in sorted(turns))
        learnt = "".join(t for _, _, r, t in sorted(turns) if r == "assistant")
        out[conv] = len(turns), *(hashlib.sha256(x.encode()).hexdigest() for x in (said, learnt)), len(learnt), invalid, state == "assistant"
    return out


def told(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_sha256, r.loss_chars, r.n_invalid, r.complete) for r in df.collect()}


def test_edge_rows(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit("own") for c in ("block", "state", "place", "loss", "own", "whole")})
    assert told(read_back(format_chats(rows))) == plain(ROWS)
    assert format_chats(rows.limit(0)).collect() == [] and read_back(format_chats(rows.limit(0))).collect() == []


def test_segments(spark):
    out = format_chats(spark.createDataFrame(ROWS, SCHEMA)).where("conv_id = 1").orderBy("block", "place", "segment").collect()
    assert "".join(r.text for r in out) == (
        "[SYS]be kind[/SYS][INST][\\INST] hi [\\\\INST] [\\/INST][/INST]<s><\\s><\\/s><\\\\s></s><s><\\s><\\/s><\\\\s></s>"
    )
    assert [r.text for r in out if r.loss] == ["<\\s><\\/s><\\\\s>"] * 2
    assert [(r.place, r.valid, r.complete) for r in out if r.segment == 0] == [(0, True, False), (1, True, False), (2, True, True), (3, False, True)]


@pytest.mark.parametrize("block", [1, 3, 7])
def test_a_long_conversation_is_dealt_to_many_tasks(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK", block)
    roles = ["user", "assistant", "tool", "user", "system", "assistant"]
    rows = [(8, t if t else None, roles[t * t % 6], f"{t} [INST]") for t in range(60)] + [(9, t, roles[t % 2], "x") for t in range(2)] + ROWS
    segments = format_chats(spark.createDataFrame(rows, SCHEMA))
    assert told(read_back(segments)) == plain(rows)
    assert segments.where("conv_id = 8").select("block").distinct().count() >= 60 // block
    assert not segments.where("conv_id = 8 and whole").count()
    assert segments.where("conv_id = 3 and not whole").count() == 0


PARTS = st.lists(st.sampled_from([*BRACKETS.controls, "\\", "[", "<", "/", "INST]", "s>", "a", " ", "\n", "中"])).map("".join)


@settings(max_examples=500, deadline=None)
@given(PARTS, PARTS, PARTS)
def test_escapes_are_undone(a, b, c):
    assert BRACKETS.unescape(BRACKETS.escape(a)) == a
    assert not any(x in BRACKETS.escape(a) for x in BRACKETS.controls)
    assert a == b or BRACKETS.escape(a) != BRACKETS.escape(b)
    turns = [("user", a), (c, b), ("assistant", c)]
    joined = "".join(s for role, text in turns for s, _ in BRACKETS.segments(role, text))
    assert BRACKETS.read(joined) == (turns, "")
    # Any beginning of it holds some whole turns, and the rest is read on.
    for cut in range(0, len(joined), 5):
        found, rest = BRACKETS.read(joined[:cut])
        assert found == turns[: len(found)] and BRACKETS.read(rest + joined[cut:])[0] == turns[len(found) :]


def test_templates_that_could_not_be_read_back():
    user = (("[U]", False), (TEXT, False), ("[/U]", False))
    other = (("[R]", False), (ROLE, False), ("[S]", False), (TEXT, False), ("[/R]", False))
    make = lambda u, o: Template({"user": u}, o, {}, "start", frozenset())
    assert make(user, other)
    for u, o in (
        (user[:2], other),
        (user[:1] + user[2:], other),
        (user, user),
        ((("[[U]", False), *user[1:]), other),
        ((("[\\U]", False), *user[1:]), other),
        ((("[", False), *user[1:]), other),
        ((user[0], user[1], user[1], user[2]), other),
    ):
        with pytest.raises(ValueError):
            make(u, o)
