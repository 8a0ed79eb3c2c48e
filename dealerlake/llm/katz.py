"""Language-model scoring: Katz backoff with Good-Turing discounts and exactly normalised backoff weights."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealerlake.llm import words as W
from dealerlake.llm.store import remainder, saved

#: Words that have a number, at most, the most frequent ones; pairs of them fit 32 bits. Every other word has the number RARE, and
#: pairs with such a side are counted under the words' 64-bit hashes instead.
FAST = 65_533
END, RARE, START = 65_533, 65_534, 65_535
#: Rows of the table of pairs: both words numbered; only the second not; only the first not; neither; and how often unnumbered words occur.
BOTH, SECOND, FIRST, NEITHER, COUNT = range(5)
#: Rows made of it, by the first word: pairs with an unnumbered first word, and the backoff weights of such words.
AFTER, WEIGHT = 5, 6
#: The documents of a block, and what they ask of the table: numbered pairs, and unnumbered words with the tokens on either side.
_DOCS, _PAIRS, _WORDS = range(10, 13)
#: Pairs resolved from a broadcast table instead of a shuffle, at most: the most frequent ones, so that no key is hot.
FREQUENT_PAIRS = 262_144
#: Counts above this are not discounted.
TOP = 5
#: Tokens a task gathers before it deals them out, tokens per bucket, pairs in a row of the table, and buckets' tasks at most.
GATHERED = 1_000_000
PER_BUCKET = 1_500_000
PER_ROW = 65_536
TASKS = 20_000


def discounts(counts_of_counts: list[int]) -> np.ndarray:
    """Katz's discount factors for counts 0 to TOP, from how many n-grams occur 1 to TOP + 1 times.

    Where Good-Turing's are undefined or not between 0 and 1, half a count is taken off instead.
    """
    n = [0, *counts_of_counts]
    half = np.array([0.0] + [(r - 0.5) / r for r in range(1, TOP + 1)])
    if not all(n[1 : TOP + 2]):
        return half
    common = (TOP + 1) * n[TOP + 1] / n[1]
    if common >= 1:
        return half
    found = [((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) for r in range(1, TOP + 1)]
    return np.array([0.0, *found]) if all(0 < d < 1 for d in found) else half


def discounted(count: np.ndarray, factors: np.ndarray) -> np.ndarray:
    return count * np.where(count > TOP, 1.0, factors[np.minimum(count, TOP)])


@dataclass
class Unigrams:
    """The numbered words (hashes ascending, their counts and numbers) and what the table of all words sums up to."""

    hash: np.ndarray
    number: np.ndarray
    count: np.ndarray  # by number; END, RARE and START included
    tokens: int
    distinct: int
    factors: np.ndarray
    mass: float  # what counts are divided by
    unknown: float  # probability of all words not seen

    def classes(self, word: np.ndarray) -> np.ndarray:
        if not len(self.hash):
            return np.full(len(word), RARE)
        spot = np.minimum(np.searchsorted(self.hash, word), len(self.hash) - 1)
        return np.where(self.hash[spot] == word, self.number[spot], RARE)

    def probability(self) -> np.ndarray:
        """Of each numbered word and of the end. The number RARE has none: such words have their own."""
        p = np.zeros(START)
        p[: END + 1] = discounted(self.count[: END + 1], self.factors) / self.mass
        return p

    def log_probability(self) -> np.ndarray:
        p = _log(self.probability())
        p[RARE] = 0.0
        return p

    def seen(self, count: np.ndarray) -> np.ndarray:
        """Probability of words that occur so often."""
        return discounted(count, self.factors) / self.mass


def _uni_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    word, count = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    docs = tokens = 0

    def merged(parts):
        nonlocal word, count
        every = np.concatenate([word, *[w for w, _ in parts]])
        times = np.concatenate([count, *[c for _, c in parts]])
        word, inverse = np.unique(every, return_inverse=True)
        count = np.bincount(inverse, times, len(word)).astype(np.int64)

    parts, held = [], 0
    for batch in batches:
        taught = np.array(batch.column("taught").to_pylist(), bool)
        for first, data, offsets in W.slices(batch.column("text")):
            found, begins = W.words(data, offsets, lower=True)
            size = np.diff(begins)
            tokens += len(found) + len(size)
            own = taught[first : first + len(size)]
            docs += int(own.sum())
            parts.append(np.unique(found[np.repeat(own, size)], return_counts=True))
            held += len(parts[-1][0])
            if held > GATHERED:
                merged(parts)
                parts, held = [], 0
    merged(parts)
    # Counts of documents and tokens ride along under no word.
    yield pa.record_batch(
        [pa.array([*([None] * 2)], pa.int64()), pa.array([docs, tokens], pa.int64()), pa.array([1, 2], pa.int32())], names=["word", "count", "total"]
    )
    yield pa.record_batch([pa.array(word.view(np.int64)), pa.array(count), pa.array(np.zeros(len(word), np.int32))], names=["word", "count", "total"])


def _pairs(batch: pa.RecordBatch, unigrams: Unigrams):
    """Per slice: number of the first text, pair of each token, text of each token, word hash of each token (0 for the end)."""
    for first, data, offsets in W.slices(batch.column("text")):
        found, begins = W.words(data, offsets, lower=True)
        size = np.diff(begins) + 1
        ends = np.cumsum(size) - 1
        is_end = np.zeros(int(size.sum()), bool)
        is_end[ends] = True
        kind = np.empty(len(is_end), np.int64)
        kind[is_end] = END
        kind[~is_end] = unigrams.classes(found)
        before = np.empty(len(is_end), np.int64)
        before[1:] = kind[:-1]
        before[ends - size + 1] = START
        word = np.zeros(len(is_end), np.uint64)
        word[~is_end] = found
        yield first, ((before << 16) | kind).astype(np.uint32), np.repeat(np.arange(len(size)), size), word


def _bucket(pair: np.ndarray, buckets: int) -> np.ndarray:
    return (W.mix(pair.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _unnumbered(pair: np.ndarray) -> np.ndarray:
    """Which pairs are counted under hashes."""
    return ((pair >> 16) == RARE) | ((pair & 0xFFFF) == RARE)


def _sides(pair: np.ndarray, word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both words of the pairs at some places: the number, or else the hash. An end has hash 0, so a text's first token follows 0."""
    prior = np.append(np.zeros(1, np.uint64), word[:-1])[at]
    before, kind = (pair[at] >> 16).astype(np.uint64), (pair[at] & 0xFFFF).astype(np.uint64)
    return np.where(before == RARE, prior, before), np.where(kind == RARE, word[at], kind)


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return W.mix(W.mix(a) * np.uint64(0x9E3779B97F4A7C15) + b)


def _word_bucket(word: np.ndarray, buckets: int) -> np.ndarray:
    return (W.mix(word) % np.uint64(buckets)).astype(np.int64)


def _summed(a: np.ndarray, b: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each pair once, in the order of its hash."""
    _, index, inverse = np.unique(_pair_hash(a, b), return_index=True, return_inverse=True)
    return a[index], b[index], np.bincount(inverse, count, len(index)).astype(np.int64)


def _by_bucket(at: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
    order = np.argsort(at, kind="stable")
    cuts = np.searchsorted(at[order], np.arange(buckets + 1))
    return [(b, order[x:y]) for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])) if y > x]


_ROWS = "bucket int, kind int, a binary, b binary, c binary, d binary"
_KINDS = {"bucket": pa.int32(), "kind": pa.int32(), "a": pa.binary(), "b": pa.binary(), "c": pa.binary(), "d": pa.binary()}


def _batches(rows: Iterator[tuple], kinds: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows as batches of some megabytes."""
    held, size = [], 0

    def batch():
        return pa.record_batch([pa.array([r[i] for r in held], kind) for i, kind in enumerate(kinds.values())], names=list(kinds))

    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if size > 1 << 22 or len(held) == 5000:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


#: Marks columns of mostly small numbers.
_SMALL = "small"


def _narrow(values: np.ndarray) -> bytes:
    """Whole numbers, after a byte that says how many bytes each takes."""
    width = next(w for w in (1, 2, 4, 8) if not len(values) or values.max() < 1 << min(8 * w, 63))
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _widened(cell) -> np.ndarray:
    width = np.frombuffer(cell, np.uint8, 1)[0]
    return np.frombuffer(cell, f"<u{width}", offset=1).astype(np.int64)


def _packed(bucket: int, kind: int, *columns: tuple[np.ndarray, str] | None) -> Iterator[tuple]:
    """Rows of the table: some columns' values, at most PER_ROW of them in a row."""
    n = next(len(c[0]) for c in columns if c)
    for at in range(0, n, PER_ROW):
        cells = []
        for c in columns:
            part = c and c[0][at : at + PER_ROW]
            cells.append(c and (_narrow(part) if c[1] == _SMALL else part.astype(c[1]).tobytes()))
        yield bucket, kind, *cells, *([None] * (4 - len(cells)))


def _hashed_rows(bucket: int, a: np.ndarray, b: np.ndarray, count: np.ndarray, ends: np.ndarray | None = None) -> Iterator[tuple]:
    """Rows of pairs with an unnumbered side, by kind: the first unnumbered word of each pair, the other word, how often the pair occurs, and
    how often an unnumbered second word does."""
    numbered = np.uint64(START + 1)
    kind = np.where(a < numbered, SECOND, np.where(b < numbered, FIRST, NEITHER))
    for k, one, other, size in ((SECOND, b, a, "<u2"), (FIRST, a, b, "<u2"), (NEITHER, a, b, "<u8")):
        i = np.flatnonzero(kind == k)
        if len(i):
            last = None if ends is None or k == FIRST else (ends[i], _SMALL)
            yield from _packed(bucket, k, (one[i], "<u8"), (other[i], size), (count[i], _SMALL), last)


def _unpacked(r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    one = np.frombuffer(r["a"], np.uint64)
    other = np.frombuffer(r["b"], "<u8" if r["kind"] == NEITHER else "<u2").astype(np.uint64)
    count = _widened(r["c"])
    return (other, one, count) if r["kind"] == SECOND else (one, other, count)


def _pair_counts(unigrams, buckets: int):
    """Pairs by bucket; those with an unnumbered second word by that word, so that a bucket knows how often it occurs, others by the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        none = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        pair, count = none
        apart, held = [], 0

        def numbered():
            for n, i in _by_bucket(_bucket(pair, buckets), buckets):
                yield from _packed(n, BOTH, (pair[i], "<u4"), None, (count[i], _SMALL))

        def hashed():
            a, b = (np.concatenate([np.zeros(0, np.uint64), *side]) for side in (zip(*apart) if apart else ((), ())))
            a, b, times = _summed(a, b, np.ones(len(a), np.int64))
            for n, i in _by_bucket(_word_bucket(np.where(b <= START, a, b), buckets), buckets):
                yield from _hashed_rows(n, a[i], b[i], times[i])

        for batch in batches:
            taught = np.array(batch.column("taught").to_pylist(), bool)
            for first, found, text, word in _pairs(batch, unigrams.value):
                own, far = taught[first + text], _unnumbered(found)
                new, often = np.unique(found[own & ~far], return_counts=True)
                pair, inverse = np.unique(np.concatenate([pair, new]), return_inverse=True)
                count = np.bincount(inverse, np.concatenate([count, often]), len(pair)).astype(np.int64)
                apart.append(_sides(found, word, np.flatnonzero(own & far)))
                held += len(apart[-1][0])
                if len(pair) > GATHERED:
                    yield from numbered()
                    pair, count = none
                if held > GATHERED:
                    yield from hashed()
                    apart, held = [], 0
        yield from numbered()
        pair, count = none
        yield from hashed()

    return lambda batches: _batches(run(batches), _KINDS)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows; their binaries are looked at where they lie."""
    for batch in batches:
        columns = {}
        for n in batch.schema.names:
            column = batch.column(n)
            if column.type in (pa.binary(), pa.large_binary()):
                columns[n] = [x.as_buffer() for x in column]
            else:
                columns[n] = column.to_pylist()
        for row in zip(*columns.values()):
            yield dict(zip(columns, row))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[dict]]]:
    """Rows that come sorted by bucket, one bucket after another."""
    return groupby(_read(batches), key=lambda r: r["bucket"])


def _table(buckets: int):
    """A bucket's pairs in order, with their counts in the whole corpus. Pairs of two unnumbered words are dealt on by the first one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for bucket, rows in _runs(batches):
            numbered, apart = [], []
            for r in rows:
                if r["kind"] == BOTH:
                    numbered.append((np.frombuffer(r["a"], np.uint32).copy(), _widened(r["c"]).astype(np.uint32)))
                else:
                    a, b, times = _unpacked(r)
                    apart.append((a.copy(), b.copy(), times.astype(np.uint32)))
            if numbered:
                pair, inverse = np.unique(np.concatenate([p for p, _ in numbered]), return_inverse=True)
                count = np.bincount(inverse, np.concatenate([c for _, c in numbered]), len(pair)).astype(np.int64)
                numbered.clear()
                yield from _packed(bucket, BOTH, (pair, "<u4"), None, (count, _SMALL))
                del pair, inverse, count
            if apart:
                a, b, times = _summed(*(np.concatenate(c) for c in zip(*apart)))
                apart.clear()
                # Every occurrence of a word follows something, so its pairs add up to its count.
                word, inverse = np.unique(b, return_inverse=True)
                often = np.bincount(inverse, times).astype(np.int64)
                far = word > START
                if far.any():
                    yield from _packed(bucket, COUNT, (word[far], "<u8"), None, (often[far], _SMALL))
                ends = often[inverse]
                to = np.where((a > START) & (b > START), _word_bucket(a, buckets), bucket)
                for at, i in _by_bucket(to, buckets):
                    yield from _hashed_rows(at, a[i], b[i], times[i], ends[i])

    return lambda batches: _batches(run(batches), _KINDS)


_COLUMNS = [*[f"n{r}" for r in range(1, TOP + 1)], "more", "seen"]


def _contexts(unigrams: Unigrams):
    """Per numbered context in a task's rows of the table: how many pairs occur 1 to TOP times, the tokens of others, and the seen words' probability.

    Context -1 has the counts of counts of all pairs, with those of TOP + 1 under "more".
    """
    probability = unigrams.probability()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((TOP + 2, START + 1))
        every = np.zeros(TOP + 2)
        for r in _read(batches):
            count = _widened(r["c"])
            every += np.bincount(np.minimum(count, TOP + 2), minlength=TOP + 3)[1:]
            if r["kind"] == BOTH:
                pair = np.frombuffer(r["a"], np.uint32)
                before, p = pair >> 16, probability[pair & 0xFFFF]
            elif r["kind"] == SECOND:
                before, p = np.frombuffer(r["b"], "<u2"), unigrams.seen(_widened(r["d"]))
            else:
                continue
            context, inverse = np.unique(before, return_inverse=True)
            n = len(context)
            for k in range(1, TOP + 1):
                held[k - 1, context] += np.bincount(inverse, count == k, n)
            held[TOP, context] += np.bincount(inverse, np.where(count > TOP, count, 0), n)
            held[TOP + 1, context] += np.bincount(inverse, p, n)
        context = np.flatnonzero(held.any(0))
        columns = np.column_stack([held[:, context], np.append(every[: TOP + 1], 0.0)])
        yield pa.record_batch([pa.array(np.append(context, -1)), *[pa.array(c) for c in columns]], names=["context", *_COLUMNS])

    return run


def _weights(unigrams, factors: np.ndarray):
    """Pairs whose first word has no number (hash, count, how often an unnumbered second word occurs), and the backoff weights of such
    words, with what their counts are divided by and whether those are left whole.

    The weights are those of ``backoff``; all pairs of a first word are in one bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        uni = unigrams.value
        probability = uni.probability()
        for bucket, rows in _runs(batches):
            parts = []
            for r in rows:
                a, b, count = _unpacked(r)
                ends = np.zeros(len(a), np.int64) if r["kind"] == FIRST else _widened(r["d"])
                p = probability[b.astype(np.int64)] if r["kind"] == FIRST else uni.seen(ends)
                parts.append((_pair_hash(a, b), a.copy(), count, ends, p))
            pair, a, count, ends, p = (np.concatenate(c) for c in zip(*parts))
            parts.clear()
            order = np.argsort(pair)  # an order for sums that does not depend on that of rows
            pair, a, count, ends, p = pair[order], a[order], count[order], ends[order], p[order]
            word, inverse = np.unique(a, return_inverse=True)
            total, cut = np.bincount(inverse, count), discounted(count, factors)
            left, unseen = total - np.bincount(inverse, cut), 1 - np.bincount(inverse, p)
            plain = unseen <= 1e-12
            full = ~plain & (left <= 1e-9)
            mass = total + full
            weight = np.ones(len(word))
            weight[~plain] = (np.where(full, 1.0, left) / mass)[~plain] / unseen[~plain]
            yield from _packed(bucket, AFTER, (pair, "<u8"), None, (count, _SMALL), (ends, _SMALL))
            yield from _packed(bucket, WEIGHT, (word, "<u8"), None, (np.log10(weight), "<f8"), (2 * mass.astype(np.int64) + plain, _SMALL))

    return lambda batches: _batches(run(batches), _KINDS)


@dataclass
class Backoff:
    """Per context: what its counts are divided by, whether they are discounted, and the log of its backoff weight."""

    mass: np.ndarray
    plain: np.ndarray
    log_weight: np.ndarray
    factors: np.ndarray

    def log_seen(self, context: np.ndarray, count: np.ndarray) -> np.ndarray:
        held = np.where(self.plain[context], count, discounted(count, self.factors))
        return np.log10(held / self.mass[context])


def backoff(rows: list, unigrams: Unigrams) -> Backoff:
    """Backoff weights: what discounts leave of a context's probability, over the probability of words not seen after it.

    A context without anything left over gets one count more to share out; one after which every word has been seen needs no discounts.
    """
    mass, plain, weight = np.maximum(unigrams.count.astype(float), 1), np.zeros(START + 1, bool), np.ones(START + 1)
    stats = {int(r["context"]): r for r in rows}
    of_counts = stats.pop(-1, None)
    factors = discounts([int(of_counts[f"n{r}"]) for r in range(1, TOP + 1)] + [int(of_counts["more"])] if of_counts else [0] * (TOP + 1))
    for context, r in stats.items():
        held = sum(factors[k] * k * r[f"n{k}"] for k in range(1, TOP + 1)) + r["more"]
        total, unseen = float(unigrams.count[context]), 1 - r["seen"]
        if unseen <= 1e-12:
            plain[context] = True
        elif total - held <= 1e-9:
            mass[context] = total + 1
            weight[context] = 1 / (total + 1) / unseen
        else:
            weight[context] = (total - held) / total / unseen
    return Backoff(mass, plain, np.log10(weight), factors)


def _log(p: np.ndarray) -> np.ndarray:
    return np.log10(np.maximum(p, 1e-300))


_ASK = _KINDS | {"block": pa.int64(), "ids": pa.list_(pa.int64())}
_ASKED = _ROWS + ", block long, ids array<long>"


def _asked(unigrams, model, frequent, buckets: int):
    """What documents ask of the table, dealt out by bucket; and per block of documents what is known without it.

    A block is the documents of one slice of text. Numbered pairs that are not in the broadcast table are asked once per document, with
    their count. Unnumbered words go to their bucket with the numbers of the tokens on either side, or the hash of a second word without
    one, and so ask of both pairs, too; a pair of two unnumbered words is asked by the first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        uni, back, (known, counts) = unigrams.value, model.value, frequent.value
        log_p, log_count = uni.log_probability(), np.log10(uni.count + 1.0)
        log_count[RARE] = 0.0
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for first, pair, text, word in _pairs(batch, uni):
                n = int(text[-1]) + 1
                before, kind = pair >> 16, pair & 0xFFFF
                # All pairs as if backed off; those that were seen are made good where their counts are known.
                value = back.log_weight[before] + log_p[kind]
                open_ = np.ones(len(pair), bool)
                if len(known):
                    spot = np.minimum(np.searchsorted(known, pair), len(known) - 1)
                    hit = np.flatnonzero(known[spot] == pair)
                    value[hit] = back.log_seen(before[hit], counts[spot[hit]])
                    open_[hit] = False
                seen = (kind != RARE) & (uni.count[kind] > 0)
                sums = np.bincount(text, minlength=n), np.bincount(text, seen, n), np.bincount(text, log_count[kind], n), np.bincount(text, value, n)
                cells = [s.astype(t).tobytes() for s, t in zip(sums, ("<i8", "<i8", "<f8", "<f8"))]
                yield block % buckets, _DOCS, *cells, block, ids[first : first + n]

                places = np.flatnonzero(kind == RARE)
                # An end follows every word, so there is a next token.
                own, near, prior, after = word[places], text[places], before[places], kind[places + 1]
                for bucket, i in _by_bucket(_word_bucket(own, buckets), buckets):
                    sides = np.concatenate([prior[i], after[i]]).astype("<u2").tobytes()
                    further = word[places[i] + 1][after[i] == RARE].tobytes()
                    yield bucket, _WORDS, own[i].tobytes(), sides, further, _narrow(near[i]), block, None
                open_ &= ~_unnumbered(pair)
                key, times = np.unique((pair[open_].astype(np.uint64) << np.uint64(32)) | text[open_].astype(np.uint64), return_counts=True)
                asked, near = (key >> np.uint64(32)).astype(np.uint32), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
                for bucket, i in _by_bucket(_bucket(asked, buckets), buckets):
                    yield bucket, _PAIRS, asked[i].tobytes(), None, _narrow(times[i]), _narrow(near[i]), block, None
                block += 1

    return lambda batches: _batches(run(batches), _ASK)


_ANSWER = {"block": pa.int64(), "bucket": pa.int32(), "docs": pa.bool_(), "a": pa.binary(), "b": pa.binary(), "c": pa.binary(), "d": pa.binary(), "ids": pa.list_(pa.int64())}
_ANSWERED = "block long, bucket int, docs boolean, a binary, b binary, c binary, d binary, ids array<long>"


def _found(known: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the asked are known, and where."""
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    spot = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    hit = np.flatnonzero(known[spot] == asked)
    return hit, spot[hit]


def _answered(unigrams, model):
    """What a bucket's pairs and words add to each document of a block: score, base score and known tokens. Rows of documents pass through.

    A bucket's rows come in order: first the table, then block by block the documents and what they ask.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        uni, back = unigrams.value, model.value
        probability, log_p = uni.probability(), uni.log_probability()

        def table(rows):
            """The table rows by kind, each in the order of its first column."""
            parts = {kind: [] for kind in (BOTH, SECOND, COUNT, AFTER, WEIGHT)}
            for r in rows:
                kind = r["kind"]
                if kind == BOTH:
                    found = np.frombuffer(r["a"], np.uint32).copy(), _widened(r["c"])
                elif kind == SECOND:
                    before, b, count = _unpacked(r)
                    at = before.astype(np.int64)
                    found = _pair_hash(before, b), back.log_seen(at, count) - back.log_weight[at] - _log(uni.seen(_widened(r["d"])))
                elif kind == COUNT:
                    found = np.frombuffer(r["a"], np.uint64).copy(), _widened(r["c"])
                elif kind == AFTER:
                    found = np.frombuffer(r["a"], np.uint64).copy(), _widened(r["c"]), _widened(r["d"])
                else:
                    found = np.frombuffer(r["a"], np.uint64).copy(), np.frombuffer(r["c"], "<f8").copy(), _widened(r["d"])
                parts[kind].append(found)
            out = {}
            for kind, found in parts.items():
                columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.uint32 if kind == BOTH else np.uint64)] + [np.zeros(0)] * 2
                found.clear()
                order = np.argsort(columns[0])
                out[kind] = [c[order] for c in columns]
            return out

        def pairs(r, known):
            pair = np.frombuffer(r["a"], np.uint32)
            hit, spot = _found(known[BOTH][0], pair)
            before, after = pair[hit] >> 16, pair[hit] & 0xFFFF
            gain = back.log_seen(before, known[BOTH][1][spot].astype(np.int64)) - back.log_weight[before] - log_p[after]
            return _widened(r["d"])[hit], gain * _widened(r["c"])[hit], np.zeros(len(hit)), np.zeros(len(hit))

        def words(r, known):
            word = np.frombuffer(r["a"], np.uint64)
            n = len(word)
            prior, after = np.frombuffer(r["b"], "<u2").astype(np.uint64).reshape(2, n)
            count, weight, mass = np.zeros(n, np.int64), np.zeros(n), np.ones(n, np.int64)
            hit, spot = _found(known[COUNT][0], word)
            count[hit] = known[COUNT][1][spot]
            hit, spot = _found(known[WEIGHT][0], word)
            weight[hit], mass[hit] = known[WEIGHT][1][spot], known[WEIGHT][2][spot]
            value = np.log10(np.where(count > 0, uni.seen(count), uni.unknown)) + weight
            # The pair that ends here, after a numbered word.
            at = np.flatnonzero(prior != RARE)
            hit, spot = _found(known[SECOND][0], _pair_hash(prior[at], word[at]))
            value[at[hit]] += known[SECOND][1][spot]
            # The pair that begins here.
            second = after.copy()
            second[after == RARE] = np.frombuffer(r["c"], np.uint64)
            hit, spot = _found(known[AFTER][0], _pair_hash(word, second))
            often, ends = (c[spot].astype(np.int64) for c in known[AFTER][1:])
            p = np.where(after[hit] == RARE, uni.seen(ends), probability[np.minimum(after[hit], END).astype(np.int64)])
            held = np.where(mass[hit] & 1, often, discounted(often, back.factors))
            value[hit] += np.log10(held / (mass[hit] >> 1)) - weight[hit] - _log(p)
            return _widened(r["d"]), value, np.log10(count + 1.0), count > 0

        for bucket, rows in _runs(batches):
            by_block = groupby(rows, key=lambda r: r["block"])
            known = None
            for block, rows in by_block:
                if block is None:
                    known = table(rows)
                    continue
                known = known or table(())
                found = []
                for r in rows:
                    if r["kind"] == _DOCS:
                        yield block, bucket, True, *(bytes(r[c]) for c in "abcd"), r["ids"]
                    else:
                        found.append((pairs if r["kind"] == _PAIRS else words)(r, known))
                if found:
                    text, *values = (np.concatenate(c) for c in zip(*found))
                    places, local = np.unique(text, return_inverse=True)
                    if len(places):
                        score, base, seen = (np.bincount(local, v, len(places)) for v in values)
                        yield block, bucket, False, _narrow(places), score.tobytes(), base.tobytes(), _narrow(seen.astype(np.int64)), None

    return lambda batches: _batches(run(batches), _ANSWER)


def _per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document of each block. Rows come sorted by block, the documents first, then by bucket, so that sums always agree."""
    names = ["doc_id", "n_tokens", "n_known", "base", "score"]
    for _, rows in groupby(_read(batches), key=lambda r: r["block"]):
        held = next(rows)
        tokens, known, base, score = (np.frombuffer(held[c], t).copy() for c, t in zip("abcd", ("<i8", "<i8", "<f8", "<f8")))
        for r in rows:
            at = _widened(r["a"])
            score[at] += np.frombuffer(r["b"], "<f8")
            base[at] += np.frombuffer(r["c"], "<f8")
            known[at] += _widened(r["d"])
        yield pa.record_batch([pa.array(held["ids"], pa.int64()), *map(pa.array, (tokens, known, base, score))], names=names)


def _grade(count):
    """Sixteen grades for each doubling of a count, from 0 on; of NumPy numbers or of a column."""
    log2, floor = (F.log2, F.floor) if isinstance(count, Column) else (np.log2, np.floor)
    return floor(log2(count) * 16)


def _least(grades: list, number: int) -> int:
    """The lowest grade that ``number`` things at most have or surpass, from (grade, how many) rows."""
    total = 0
    for grade, n in sorted(grades, reverse=True):
        total += n
        if total > number:
            return int(grade) + 1
    return 0


def _pair_grades(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many of a task's numbered pairs have each grade."""
    found = np.zeros(1, np.int64)
    for r in _read(batches):
        own = np.bincount(_grade(_widened(r["c"])).astype(np.int64))
        found = np.pad(found, (0, max(0, len(own) - len(found))))
        found[: len(own)] += own
    grade = np.flatnonzero(found)
    yield pa.record_batch([pa.array(grade), pa.array(found[grade])], names=["grade", "n"])


def _top_pairs(least: int):
    """Numbered pairs of a grade or above that occur twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _read(batches):
            count = _widened(r["c"])
            often = np.flatnonzero((count > 1) & (_grade(count) >= least))
            if len(often):
                yield pa.record_batch([pa.array(np.frombuffer(r["a"], np.uint32)[often].astype(np.int64)), pa.array(count[often])], names=["pair", "count"])

    return run


@dataclass
class KatzModel:
    """The stored tables: ``words`` (word hash, count), ``pairs`` (see ``_hashed_rows``) and ``weights``, by bucket; and what is broadcast of them."""

    words: DataFrame
    pairs: DataFrame
    weights: DataFrame
    unigrams: Unigrams
    backoff: Backoff
    frequent: tuple[np.ndarray, np.ndarray]
    buckets: int


def _prepared(docs: DataFrame, taught) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), taught.alias("taught"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def _dealt(rows: DataFrame, buckets: int, *order: str) -> DataFrame:
    """Rows of a bucket together and in order. A task has one bucket, or several one after another."""
    return rows.repartition(min(buckets, TASKS), "bucket").sortWithinPartitions("bucket", *order)


def train(docs: DataFrame, taught) -> KatzModel:
    """Counts words and pairs of the rows of ``docs`` (doc_id, text) for which the column ``taught`` is true."""
    spark = docs.sparkSession
    rows = _prepared(docs, taught).select("taught", "text")
    counted = saved(rows.mapInArrow(_uni_counts, "word long, count long, total int").groupBy("word", "total").agg(F.sum("count").alias("count")))
    totals = {r["total"]: r["count"] for r in counted.where("total > 0").collect()}
    n_docs, all_tokens = totals.get(1, 0), totals.get(2, 0)
    words = counted.where("total = 0").select("word", "count")
    sums = words.agg(F.sum("count"), F.count("*"), *[F.sum((F.col("count") == r).cast("long")) for r in range(1, TOP + 2)]).first()
    tokens, distinct = (sums[0] or 0) + n_docs, sums[1] + (n_docs > 0)
    of_counts = [(sums[1 + r] or 0) + (n_docs == r) for r in range(1, TOP + 2)]
    # By grades of counts, so that the driver gets FAST words at most, from all tasks together.
    least = _least(words.groupBy(_grade(F.col("count")).alias("grade")).agg(F.count("*")).collect(), FAST)
    top = words.where(_grade(F.col("count")) >= least).toPandas().sort_values(["count", "word"], ascending=[False, True])
    hashes = top["word"].to_numpy(np.int64).view(np.uint64)
    count = np.zeros(START + 1, np.int64)
    count[: len(top)] = top["count"].to_numpy(np.int64)
    count[END], count[START] = n_docs, n_docs
    count[RARE] = (sums[0] or 0) - int(count[: len(top)].sum())
    factors = discounts(of_counts)
    left = sum((1 - factors[r]) * r * of_counts[r - 1] for r in range(1, TOP + 1))
    mass = float(tokens) if left > 1e-9 else tokens + 1.0
    order = np.argsort(hashes)
    unigrams = Unigrams(hashes[order], order.astype(np.int64), count, tokens, distinct, factors, mass, (left if left > 1e-9 else 1.0) / mass)
    sent = spark.sparkContext.broadcast(unigrams)
    buckets = max(1, -(-all_tokens // PER_BUCKET))
    pairs = saved(_dealt(rows.mapInArrow(_pair_counts(sent, buckets), _ROWS), buckets, "kind").mapInArrow(_table(buckets), _ROWS))
    contexts = pairs.where(F.col("kind") != COUNT).mapInArrow(_contexts(unigrams), "context long, " + ", ".join(f"{c} double" for c in _COLUMNS))
    # Sums in a fixed order, so that reruns agree.
    summed = contexts.groupBy("context").agg(*[F.sum(F.col(c).cast("decimal(38,18)")).cast("double").alias(c) for c in _COLUMNS])
    numbered = pairs.where(F.col("kind") == BOTH)
    least = _least(numbered.mapInArrow(_pair_grades, "grade long, n long").groupBy("grade").agg(F.sum("n")).collect(), FREQUENT_PAIRS)
    top_pairs = numbered.mapInArrow(_top_pairs(least), "pair long, count long").toPandas().sort_values("pair")
    frequent = top_pairs["pair"].to_numpy(np.int64).astype(np.uint32), top_pairs["count"].to_numpy(np.int64)
    back = backoff(summed.collect(), unigrams)
    weights = saved(_dealt(pairs.where(F.col("kind").isin(FIRST, NEITHER)), buckets).mapInArrow(_weights(sent, back.factors), _ROWS))
    return KatzModel(words, pairs, weights, unigrams, back, frequent, buckets)


def score(docs: DataFrame, model: KatzModel, taught) -> DataFrame:
    """See ``language_model``."""
    context = docs.sparkSession.sparkContext
    uni = model.unigrams
    unigrams, back, frequent = (context.broadcast(x) for x in (uni, model.backoff, model.frequent))
    asked = _prepared(docs, taught).mapInArrow(_asked(unigrams, back, frequent, model.buckets), _ASKED)
    known = model.pairs.where(F.col("kind").isin(BOTH, SECOND, COUNT)).union(model.weights)
    table = known.withColumns({"block": F.lit(None).cast("long"), "ids": F.lit(None).cast("array<long>")})
    answers = _dealt(table.unionByName(asked), model.buckets, "block", "kind").mapInArrow(_answered(unigrams, back), _ANSWERED)
    by_block = answers.repartition(min(model.buckets, TASKS), "block").sortWithinPartitions("block", ~F.col("docs"), "bucket")
    total = by_block.mapInArrow(_per_document, "doc_id long, n_tokens long, n_known long, base double, score double")
    return total.select(
        "doc_id", "n_tokens", "n_known", F.lit(uni.tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * float(np.log10(uni.tokens + uni.distinct + 1))).alias("base_score"),
        (F.col("score") if uni.tokens > 0 else F.lit(0.0)).alias("score"),
    )


def language_model(docs: DataFrame, divisor: int = 7, left_out: int = 2) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from documents whose crc32(doc_id) mod ``divisor`` is not ``left_out``; ``held_out`` marks the others. A
    text is its words, A-Z lower-cased, and an end. ``base_score`` is add-one smoothing of single tokens; ``score`` is log10 of
    the text's probability under the model, token by token:

    * P(word | word before) = discounted count of the pair / count of the word before, if the pair was seen;
    * else the backoff weight of the word before, times P(word). The weight makes the probabilities after a word
      add up to 1 exactly.
    * P(word) = discounted count / tokens. What discounts leave over is shared by words never seen, as one.

    Every word and every pair has its own count, over all training documents, whole texts.

    Words are counted under a 64-bit hash, summed in each task first. The FAST most frequent words have numbers; those, their
    backoff weights and the most frequent pairs are of fixed size and broadcast, so neither common words nor common pairs
    are shuffled. Everything else is dealt to buckets of a bounded number of tokens, whose number grows with the corpus: pairs under their numbers or a
    64-bit hash, with their counts, and the counts and backoff weights of unnumbered words. There they meet what blocks of documents
    ask, and sums per document come back. A task holds one bucket at a time.

    Null texts are empty, one token. Without training documents all scores are 0. Rows that repeat an id count
    each in training and are each scored. An empty table gives an empty one.
    """
    fold = remainder(F.col("doc_id").cast("long"), divisor)
    model = train(docs, fold != left_out)
    scored = score(docs, model, fold != left_out)
    return scored.select(
        "doc_id", (remainder(F.col("doc_id"), divisor) == left_out).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
