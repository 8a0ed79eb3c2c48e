"""Words of whole Arrow batches of texts as arrays: boundaries and 64-bit hashes, without a Python loop over words.

A word is a longest run of bytes outside ``\\x20 \\x09-\\x0D``. Nulls count as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer text is worked on alone.
SLICE_BYTES = 1 << 20

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


class _Powers:
    """Powers of the hash base and of its inverse, grown when a longer slice comes."""

    up = down = np.ones(0, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, SLICE_BYTES // 4)
            for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
                steps = np.full(size, base)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps, dtype=np.uint64))
        return cls.up[:n], cls.down[:n]


def slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts as (number of the first, bytes, offsets); offsets begin at 0."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + SLICE_BYTES, "right")) - 1)
        last = min(last, n)
        yield first, raw[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def bounds(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word; no word crosses from one text into the next.

    ``blank`` says of each byte whether it stands between words.
    """
    solid = ~blank[data]
    if not solid.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty_like(solid)
    before[0] = False
    before[1:] = solid[:-1]
    edges = offsets[1:-1]
    before[edges[edges < len(data)]] = False
    after = np.empty_like(solid)
    after[-1] = False
    after[:-1] = solid[1:]
    after[edges[edges > 0] - 1] = False
    return np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of ``data``."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _Powers.to(len(data))
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * up, out=sums[1:])
    spans = (sums[ends] - sums[starts]) * down[starts]
    return mix(spans + (ends - starts).astype(np.uint64) * _BASE)


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words begin (one more entry than texts)."""
    starts, ends = bounds(data, offsets)
    return hashes(LOWER[data] if lower else data, starts, ends), np.searchsorted(starts, offsets)


def shingles(word: np.ndarray, begins: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and where each text's runs begin.

    A text with fewer words has one run, all its words; a text without words has none.
    """
    counts = np.diff(begins)
    with np.errstate(over="ignore"):
        n = len(word)
        run = mix(word + np.uint64(size))
        for step in range(1, size):
            left = max(n - step, 0)
            run[:left] = mix(run[:left] * _BASE + word[step:])
        own = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
        total = np.concatenate([[0], np.cumsum(own)])
        place = np.arange(total[-1]) - np.repeat(total[:-1], own) + np.repeat(begins[:-1], own)
        out = run[place]
        for i in np.flatnonzero((counts > 0) & (counts < size)):
            whole = word[begins[i] : begins[i + 1]]
            h = mix(whole[:1] + np.uint64(len(whole)))
            for w in whole[1:]:
                h = mix(h * _BASE + w)
            out[total[i]] = h[0]
    return out, total
