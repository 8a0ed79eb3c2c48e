"""Chat formatting: a finite-state machine over roles checks the order of turns, and a declarative template emits text segments with loss flags."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Placeholders of a template: a turn's escaped text and the escaped name of its role.
TEXT, ROLE = "{text}", "{role}"
#: Turns of a conversation that one task handles together: those whose numbers share a quotient by this.
BLOCK = 4096

Segment = tuple[str, bool]


@dataclass(frozen=True)
class Template:
    """How turns are written, and in which order they may come.

    ``turns`` gives the segments of each role, (control string or placeholder, whether it bears loss); ``other`` those of every
    other role, which has to carry ``ROLE``. ``moves`` maps (state, role) to the next state, from ``start`` on. A conversation is
    complete in a state of ``final``. A turn without a move is invalid; the machine goes on in the state named like its role.

    Texts and role names are escaped: of each control string in them, any backslashes behind its first character get one
    more, ``[INST]`` becoming ``[\\INST]`` and ``[\\INST]`` becoming ``[\\\\INST]``. So an escaped text holds no control string, texts
    without any stay as they are, and taking one backslash away gives the text back. That needs control strings of two or more
    characters, whose first characters occur nowhere else in them, and a control string before and after each placeholder.
    """

    turns: Mapping[str, tuple[Segment, ...]]
    other: tuple[Segment, ...]
    moves: Mapping[tuple[str, str], str]
    start: str
    final: frozenset[str]

    def __post_init__(self):
        heads = {c[0] for c in self.controls}
        for c in self.controls:
            if len(c) < 2 or "\\" in c or heads & set(c[1:]):
                raise ValueError(f"a text could not be told from the control string {c!r}")
        for segments in [*self.turns.values(), self.other]:
            held = [s in (TEXT, ROLE) for s, _ in segments]
            if held[0] or held[-1] or any(a and b for a, b in zip(held, held[1:])) or [s for s, _ in segments].count(TEXT) != 1:
                raise ValueError("a turn holds its text once, and every placeholder between control strings")
        if len({s[0][0] for s in [*self.turns.values(), self.other]}) <= len(self.turns):
            raise ValueError("every kind of turn begins with its own control string")

    @cached_property
    def controls(self) -> list[str]:
        return sorted({s for segments in [*self.turns.values(), self.other] for s, _ in segments} - {TEXT, ROLE}, key=lambda c: (-len(c), c))

    @cached_property
    def states(self) -> list[str]:
        return sorted({self.start, *self.turns, *(s for s, _ in self.moves), *self.moves.values()})

    @cached_property
    def _inside(self) -> re.Pattern:
        heads = sorted({c[0] for c in self.controls})
        tails = {h: "|".join(re.escape(c[1:]) for c in self.controls if c[0] == h) for h in heads}
        return re.compile("|".join(rf"{re.escape(h)}\\*(?={tails[h]})" for h in heads))

    @cached_property
    def _control(self) -> re.Pattern:
        return re.compile("|".join(map(re.escape, self.controls)))

    @cached_property
    def _openers(self) -> dict[str, tuple[str | None, tuple[Segment, ...]]]:
        return {s[0][0]: (role, s) for role, s in [*self.turns.items(), (None, self.other)]}

    def escape(self, text: str) -> str:
        return self._inside.sub(lambda m: m.group() + "\\", text)

    def unescape(self, text: str) -> str:
        return self._inside.sub(lambda m: m.group()[:-1], text)

    def segments(self, role: str, text: str) -> list[Segment]:
        """The segments of one turn."""
        held = {TEXT: text, ROLE: role}
        return [(self.escape(held[s]) if s in held else s, loss) for s, loss in self.turns.get(role, self.other)]

    def move(self, state: str, role: str) -> tuple[str, bool]:
        """The state after a turn, and whether the turn may come there."""
        after = self.moves.get((state, role))
        if after is not None:
            return after, True
        return (role if role in self.turns else state), False

    def read(self, text: str) -> tuple[list[tuple[str, str]], str]:
        """The (role, text) of the whole turns a formatted text begins with, and what follows them."""
        turns, at = [], 0
        while at < len(text):
            opener = self._control.match(text, at)
            if not opener:
                if any(c.startswith(text[at:]) for c in self.controls):
                    break
                raise ValueError("a turn begins with a control string")
            role, segments = self._openers[opener.group()]
            found, here = {ROLE: role}, at
            for what, _ in segments:
                if what in (TEXT, ROLE):
                    end = self._control.search(text, here)
                    if not end:
                        break
                    found[what], here = self.unescape(text[here : end.start()]), end.start()
                elif text.startswith(what, here):
                    here += len(what)
                else:
                    break
            else:
                turns.append((found[ROLE], found[TEXT]))
                at = here
                continue
            break
        return turns, text[at:]


#: A system turn may come first; user and assistant take turns; only what the assistant says bears loss.
BRACKETS = Template(
    turns={
        "system": (("[SYS]", False), (TEXT, False), ("[/SYS]", False)),
        "user": (("[INST]", False), (TEXT, False), ("[/INST]", False)),
        "assistant": (("<s>", False), (TEXT, True), ("</s>", False)),
    },
    other=(("[ROLE]", False), (ROLE, False), ("[SAYS]", False), (TEXT, False), ("[/ROLE]", False)),
    moves={
        ("start", "system"): "system",
        ("start", "user"): "user",
        ("system", "user"): "user",
        ("user", "assistant"): "assistant",
        ("assistant", "user"): "user",
    },
    start="start",
    final=frozenset({"assistant"}),
)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, dict]]:
    """Rows, each with whether it is the first of its conversation's block."""
    last = ()
    for batch in batches:
        for r in batch.to_pylist():
            yield (r["conv_id"], r["block"]) != last, r
            last = r["conv_id"], r["block"]


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in batches of some thousand, or of four million characters."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, str))
        if len(held) >= 5000 or size > 4_000_000:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_ENTRY = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("state", pa.list_(pa.string()))])


def _maps(template: Template):
    """Per block, the state it leads to from every state."""

    def rows(batches):
        held, after = None, None
        for new, r in _chunks(batches):
            if new:
                if held:
                    yield *held, after
                held, after = (r["conv_id"], r["block"]), template.states
            after = [template.move(s, r["role"])[0] for s in after]
        if held:
            yield *held, after

    return lambda batches: _batched(rows(batches), _ENTRY)


def _entries(template: Template):
    """Per block, the state in which it begins."""

    def rows(batches):
        conv, state = (), None
        for _, r in _chunks(batches):
            if (r["conv_id"],) != conv:
                conv, state = (r["conv_id"],), template.start
            yield r["conv_id"], r["block"], [state]
            state = r["state"][template.states.index(state)]

    return lambda batches: _batched(rows(batches), _ENTRY)


_SEGMENT = pa.schema(
    [("conv_id", pa.int64()), ("block", pa.int64()), ("place", pa.int64()), ("segment", pa.int32()), ("text", pa.string()), ("loss", pa.bool_())]
    + [("turn", pa.int64()), ("role", pa.string()), ("valid", pa.bool_()), ("complete", pa.bool_()), ("whole", pa.bool_())]
)


def _segments(template: Template):
    def rows(batches):
        state, place, whole = template.start, 0, True
        for new, r in _chunks(batches):
            if new:
                state, place, whole = template.start, 0, True
            if r["state"] is not None:
                state, whole = r["state"][0], False
                continue
            state, valid = template.move(state, r["role"])
            for n, (text, loss) in enumerate(template.segments(r["role"], r["text"])):
                yield r["conv_id"], r["block"], place, n, text, loss, r["turn"], r["role"], valid, state in template.final, whole
            place += 1

    return lambda batches: _batched(rows(batches), _SEGMENT)


_SEGMENTS = "conv_id long, block long, place long, segment int, text string, loss boolean, turn long, role string, valid boolean, complete boolean, whole boolean"


def format_chats(conversations: DataFrame, template: Template = BRACKETS) -> DataFrame:
    """The segments of all ``conversations`` (conv_id, turn, role, text), one row each, texts joined in order being the formatted chat.

    Columns: conv_id; block, place and segment, which order a conversation's segments; text; loss, whether the segment bears
    loss; turn, role; valid, whether the machine allows the turn; complete, whether the conversation could end with it; whole,
    whether all its segments have this block. The rows of a block come in order, one after another.

    Turns come by their number, the same number by role and text; null numbers come first. Null texts and roles are empty,
    unknown roles are written with their name and are invalid, repeated rows are turns of their own, all rows with a null id
    are one conversation, further columns are left out, and an empty table gives an empty one.

    Tasks get conversations in blocks of turn numbers, so a conversation with very many turns is dealt to many of them. The state in which
    each of its blocks begins is found first, without texts: a block maps every state to a state, and these maps are
    applied one after another. Texts are shuffled once. Only turns with one and the same number stay in one task whatever their number.
    """
    empty = F.lit("")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.expr(f"cast(turn as bigint) div {BLOCK}").alias("block"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    )
    # Null numbers lie before all others, in a block of their own.
    block = F.coalesce("block", F.lit(-(1 << 63)).cast("long"))
    long_ones = rows.groupBy("conv_id").agg(F.min(block).alias("low"), F.max(block).alias("high")).where("low < high").select(F.col("conv_id").alias("own"))
    roles = rows.drop("text").join(long_ones, F.col("conv_id").eqNullSafe(F.col("own")), "left_semi")
    entry = "conv_id long, block long, state array<string>"
    maps = roles.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "turn", "role").mapInArrow(_maps(template), entry)
    entries = maps.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(_entries(template), entry)
    every = rows.withColumn("state", F.lit(None).cast("array<string>")).unionByName(entries, allowMissingColumns=True)
    ordered = every.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", F.col("state").isNull(), "turn", "role", "text")
    return ordered.mapInArrow(_segments(template), _SEGMENTS)


class _Digest:
    """What is told of one conversation, from its turns as they were read back."""

    def __init__(self):
        self.turns = self.loss_chars = self.chars = self.invalid = 0
        self.complete = False
        self.said, self.learnt = hashlib.sha256(), hashlib.sha256()

    def add(self, role, text, learnt, chars, valid, complete):
        self.said.update(f"{role}\n{text}\n".encode())
        self.learnt.update(learnt.encode())
        self.turns += 1
        self.loss_chars += len(learnt)
        self.chars += chars
        self.invalid += not valid
        self.complete = complete

    def row(self):
        return self.turns, self.said.hexdigest(), self.loss_chars, self.learnt.hexdigest(), self.chars, self.invalid, self.complete


_TURN = [("role", pa.string()), ("said", pa.string()), ("learnt", pa.string()), ("chars", pa.int64()), ("valid", pa.bool_()), ("ends", pa.bool_())]
_DIGEST = [("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string())] + [
    ("formatted_chars", pa.int64()), ("n_invalid", pa.int64()), ("complete", pa.bool_())
]
_BACK = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("place", pa.int64()), *_TURN, *_DIGEST])
_READ = (
    "conv_id long, block long, place long, role string, said string, learnt string, chars long, valid boolean, ends boolean, "
    "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_invalid long, complete boolean"
)


def _turns_read(template: Template):
    """Turns read from the joined segments: a digest per conversation that is whole here, a row per turn of others."""

    def rows(batches):
        held, digest, text, learnt, chars = None, _Digest(), "", [], 0

        def end():
            if text:
                raise ValueError("a conversation ends within a turn")
            return [(*held, None, *([None] * len(_TURN)), *digest.row())] if held and digest.turns else []

        for new, r in _chunks(batches):
            if new:
                yield from end()
                held, digest = (r["conv_id"], r["block"]), _Digest()
            text += r["text"]
            chars += len(r["text"])
            if r["loss"]:
                learnt.append(template.unescape(r["text"]))
            turns, text = template.read(text)
            for role, said in turns:
                turn = role, said, "".join(learnt), chars, r["valid"], r["complete"]
                if r["whole"]:
                    digest.add(*turn)
                else:
                    yield *held, r["place"], *turn, *([None] * len(_DIGEST))
                learnt, chars = [], 0
        yield from end()

    return lambda batches: _batched(rows(batches), _BACK)


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        conv, digest = (), None
        for batch in batches:
            for r in batch.to_pylist():
                if digest and (r["conv_id"],) != conv:
                    yield *conv, *digest.row()
                    digest = None
                conv = (r["conv_id"],)
                if r["n_turns"] is not None:
                    yield *conv, *(r[n] for n, _ in _DIGEST)
                    continue
                digest = digest or _Digest()
                digest.add(r["role"], r["said"], r["learnt"], r["chars"], r["valid"], r["ends"])
        if digest:
            yield *conv, *digest.row()

    return _batched(rows(), pa.schema([("conv_id", pa.int64()), *_DIGEST]))


def read_back(segments: DataFrame, template: Template = BRACKETS) -> DataFrame:
    """Per conversation of ``format_chats``'s segments, as read from their joined texts: conv_id, n_turns, turns_sha256 (of role, line break, text, line
    break per turn), loss_chars and loss_sha256 (of the unescaped text that bears loss), formatted_chars, n_invalid, complete.

    Conversations that lie in one block are read where they were written. Others are put together by conversation, their turns
    streaming through one task, as a hash over a text can't be split; nothing is held but one turn.
    """
    back = segments.mapInArrow(_turns_read(template), _READ).repartition("conv_id").sortWithinPartitions("conv_id", "block", "place")
    names = _READ.split(", ")
    return back.mapInArrow(_told, ", ".join([names[0], *names[-len(_DIGEST) :]]))
