"""Packing documents into training sequences whose sources keep to target proportions: deficit round-robin over source queues."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealerlake.llm.pieces import token_ids
from dealerlake.llm.store import saved

LENGTH = 2048
#: Id put after every document.
END = 1
#: A source is served again once its credit reaches so many tokens.
LEAST = 32


class Schedule:
    """Which tokens of each source queue lie where in the stream of all sequences, in closed form.

    Rounds are windows: in each, a source earns its share of LENGTH tokens, fractions of it carried on
    as its deficit, and is served all whole tokens it has earned. A source that earns little is served
    every so many rounds only, when its credit has reached LEAST tokens. What a source has been served
    after any number of rounds follows from the totals alone, so tasks place documents without
    talking to each other, and deficits carry across windows and partitions alike.
    """

    def __init__(self, totals: list[int], shares: list[float], length: int = LENGTH, least: int = LEAST):
        self.length = length
        self.totals = np.array(totals, np.int64)
        self.all = int(self.totals.sum())
        self.rounds = -(-self.all // length)
        self.full = self.all // length
        left, share = self.totals.astype(float), np.array(shares, float)
        # Breakpoints: where a queue runs dry and its share goes to the others.
        at, served = [0.0], [np.zeros(len(left))]
        while (left > 0).any():
            earns = np.where(left > 0, share, 0.0)
            if earns.sum() == 0:  # only sources without a share are left
                earns = np.where(left > 0, left, 0.0)
            earns = earns / earns.sum()
            step = np.min(left[earns > 0] / earns[earns > 0])
            dry = (earns > 0) & (left <= earns * step * (1 + 1e-12))
            left = np.where(dry, 0.0, left - earns * step)
            at.append(at[-1] + step)
            served.append(np.where(left == 0, self.totals, self.totals - left))
        self.at, self.served = np.array(at), np.array(served).T.copy()
        slopes = np.diff(self.served, axis=1) / np.diff(self.at) if len(self.at) > 1 else np.ones((len(left), 1))
        # Breakpoints may be as many as sources; the thinnest share while a queue lasts sets its pace.
        slowest = np.where(slopes > 0, slopes, np.inf).min(axis=1, initial=np.inf)
        slowest = np.where(np.isfinite(slowest), slowest, 1.0)
        self.every = np.clip(np.ceil(least / (length * slowest)), 1, max(1, self.rounds)).astype(np.int64)
        self.phase = np.arange(len(left)) % self.every
        self.turns = -(-self.rounds // self.every)

    def before(self, source: int, turn: np.ndarray) -> np.ndarray:
        """Tokens of the source served before its given turn."""
        turn = np.asarray(turn, np.int64)
        earned = np.interp(turn * self.every[source] * float(self.length), self.at, self.served[source])
        earned = np.minimum(np.floor(earned).astype(np.int64), self.totals[source])
        return np.where(turn <= 0, 0, np.where(turn >= self.turns[source], self.totals[source], earned))

    def round_of(self, source: int, turn: np.ndarray) -> np.ndarray:
        return np.minimum(turn * self.every[source] + self.phase[source], self.rounds - 1)

    def turns_before(self, source: int, at_round: np.ndarray) -> np.ndarray:
        """Turns of the source in earlier rounds."""
        turns = -((self.phase[source] - at_round) // self.every[source])
        return np.where(at_round >= self.rounds, self.turns[source], np.clip(turns, 0, self.turns[source]))

    def position(self, source: int, turn: np.ndarray) -> np.ndarray:
        """Where a turn's tokens begin in the stream."""
        at_round = self.round_of(source, turn)
        total = np.zeros(len(at_round), np.int64)
        for other in range(len(self.totals)):
            total += self.before(other, self.turns_before(other, at_round + (other < source)))
        # Several turns meet in the last round: those of the source itself come in order.
        return total + self.before(source, turn) - self.before(source, self.turns_before(source, at_round))

    def turn_of(self, source: int, token: np.ndarray) -> np.ndarray:
        """The turn that serves a token of the queue."""
        low, high = np.zeros(len(token), np.int64), np.full(len(token), self.turns[source], np.int64)
        while (high - low > 1).any():
            middle = (low + high) // 2
            there = self.before(source, middle) <= token
            low, high = np.where(there, middle, low), np.where(there, high, middle)
        return low

    def tail(self) -> list[tuple[int, int]]:
        """(position, sequence) of the parts after the last full sequence; their lengths are powers of two."""
        position, out, left = self.full * self.length, [], self.all - self.full * self.length
        while left:
            size = 1 << (left.bit_length() - 1)
            out.append((position, self.full + len(out)))
            position, left = position + size, left - size
        return out

    def pieces(self, source: int, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """(document, first id in it, length, sequence, offset) of stretches of the source's queue."""
        first, last = self.turn_of(source, begin), self.turn_of(source, begin + size - 1)
        count = last - first + 1
        doc = np.repeat(np.arange(len(begin)), count)
        turn = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + first[doc]
        start, end = self.before(source, turn), self.before(source, turn + 1)
        low, high = np.maximum(start, begin[doc]), np.minimum(end, (begin + size)[doc])
        position = self.position(source, turn) + low - start
        some = high > low
        doc, low, position, length = doc[some], low[some], position[some], (high - low)[some]
        # Cut at the ends of sequences.
        cuts = (position + length - 1) // self.length - position // self.length + 1
        each = np.repeat(np.arange(len(doc)), cuts)
        step = np.arange(len(each)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        edge = (position[each] // self.length + step) * self.length
        a = np.maximum(position[each], edge)
        b = np.minimum((position + length)[each], edge + self.length)
        for border, _ in self.tail()[1:]:
            across = np.flatnonzero((a < border) & (b > border))
            each = np.concatenate([each, each[across]])
            a, b = np.concatenate([a, np.full(len(across), border)]), np.concatenate([b, b[across]])
            b[across] = border
        sequence, offset = a // self.length, a % self.length
        for border, number in self.tail():
            inside = a >= border
            sequence, offset = np.where(inside, number, sequence), np.where(inside, a - border, offset)
        return doc[each], low[each] + a - position[each] - begin[doc[each]], b - a, sequence, offset


def _tokenised(path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        filled: dict[str | None, int] = {}
        for batch in batches:
            ids, size, begin = [], [], []
            source = batch.column("source").to_pylist()
            for first, flat, at in token_ids(path, batch.column("text")):
                for i in range(len(at) - 1):
                    own = np.append(flat[at[i] : at[i + 1]], np.uint32(end))
                    ids.append(own.astype("<u4").tobytes() if own.max() > 0xFFFF else own.astype("<u2").tobytes())
                    size.append(len(own))
                    queue = source[first + i]
                    begin.append(filled.get(queue, 0))
                    filled[queue] = begin[-1] + len(own)
            yield pa.record_batch(
                [pa.array([part] * len(ids), pa.int32()), batch.column("source"), batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(begin, pa.int64()), pa.array(ids, pa.binary())],
                names=["part", "source", "doc_id", "doc_tokens", "begin", "packed"],
            )

    return run


def _placed(schedule: Schedule, number: dict[str | None, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source = np.array([number[s] for s in batch.column("source").to_pylist()], np.int64)
            begin, size = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("begin", "doc_tokens"))
            packed = batch.column("packed")
            for each in np.unique(source):
                rows = np.flatnonzero(source == each)
                doc, start, length, sequence, offset = schedule.pieces(int(each), begin[rows], size[rows])
                order = np.lexsort((start, doc))
                doc, start, length, sequence, offset = (x[order] for x in (doc, start, length, sequence, offset))
                # Ids of a million at most are unpacked at once.
                for part in np.array_split(np.arange(len(doc)), max(1, int(length.sum()) >> 20)):
                    if not len(part):
                        continue
                    ids, held, own = [], -1, b""
                    for i in part:
                        if doc[i] != held:
                            held = doc[i]
                            row = int(rows[held])
                            raw = packed[row].as_py()
                            own = raw if len(raw) == 4 * size[row] else np.frombuffer(raw, "<u2").astype("<u4").tobytes()
                        ids.append(own[4 * start[i] : 4 * (start[i] + length[i])])
                    taken = pa.array(rows[doc[part]])
                    yield pa.record_batch(
                        [
                            batch.column("doc_id").take(taken),
                            pa.array(start[part]),
                            pa.array(length[part]),
                            pa.array(ids, pa.binary()),
                            batch.column("doc_tokens").take(taken),
                            batch.column("source").take(taken),
                            pa.array(sequence[part]),
                            pa.array(offset[part]),
                        ],
                        names=["doc_id", "start", "length", "ids", "doc_tokens", "source", "sequence_id", "offset"],
                    )

    return run


def pack(docs: DataFrame, tokenizer: str, shares: dict[str | None, float] | None = None, length: int = LENGTH, end: int = END) -> DataFrame:
    """Pieces of all documents (doc_id, text, source) in sequences of ``length`` ids.

    A document is the tokenizer's ids of its text, then ``end``. Each row is a piece: doc_id, start (ids
    of the document before it), length, ids (little-endian 32-bit), doc_tokens, source, sequence_id, offset.
    Every id lies in one piece and every sequence is filled without gaps. What is left after the last
    full sequence becomes sequences whose lengths are powers of two, so nothing is padded.

    ``shares`` are the target proportions of the sources in every sequence; a source not named has
    none and comes last. Without ``shares`` they are the sources' parts of all ids, which keeps every
    sequence like the whole and lets all queues end together. With others, a source's share goes to
    those that remain once it is used up, since every document is packed once.

    One pass tokenises, and writes 16-bit ids with each document's place among those of its
    source in its task; sums per task and source give its place in the queue; ``Schedule`` gives
    the rest. Only one number per source reaches the driver, and documents are never
    shuffled while the sums are few enough to be broadcast by Spark's own size check.

    Null texts are empty ones, one id. Documents without a source are a source of their own. Rows that
    repeat an id are packed each by itself. An empty table gives an empty one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("source").cast("string").alias("source"))
    tokens = saved(docs.mapInArrow(_tokenised(tokenizer, end), "part int, source string, doc_id long, doc_tokens long, begin long, packed binary"))
    sums = saved(tokens.groupBy("part", "source").agg(F.sum("doc_tokens").alias("tokens")))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = saved(sums.select(F.col("part").alias("p"), F.col("source").alias("s"), F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("ahead")))
    totals = {r["source"]: r["tokens"] for r in sums.groupBy("source").agg(F.sum("tokens").alias("tokens")).collect()}
    names = sorted(totals, key=lambda s: (s is None, s))
    schedule = Schedule([totals[s] for s in names], [float((totals if shares is None else shares).get(s, 0)) for s in names], length)
    queued = tokens.join(starts, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "doc_id", "doc_tokens", (F.col("begin") + F.col("ahead")).alias("begin"), "packed"
    )
    return queued.mapInArrow(
        _placed(schedule, {s: i for i, s in enumerate(names)}),
        "doc_id long, start long, length long, ids binary, doc_tokens long, source string, sequence_id long, offset long",
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """The sequences themselves: sequence_id, ids (little-endian 32-bit). A group has one sequence's pieces."""
    row = F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return pieces.groupBy("sequence_id").agg(F.unhex(F.array_join(F.transform(row, lambda r: r["ids"]), "")).alias("ids"))
