"""Splitting texts into the pieces that a tokenizer's merges never cross, over whole Arrow batches.

The tokenizers library encodes each distinct piece once; texts are put together from the pieces. A text
goes to the library as a whole where this can't be relied on: special strings in it, or code points
outside a table of those whose class has been the same since Unicode 3.2. So the ids are always those
of the library for the whole text.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

from dealerlake.llm import words as W

LETTER, NUMBER, SPACE, OTHER, UNSURE = range(5)
_BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def _kind(category: str) -> int:
    return {"L": LETTER, "N": NUMBER}.get(category[0], UNSURE if category in ("Cn", "Cs", "Co", "Cc", "Zs", "Zl", "Zp") else OTHER)


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per code point below 65,536: its class, its class for the folding tokenizer, its lower case."""
    old = unicodedata.ucd_3_2_0
    plain = np.full(0x10000, UNSURE, np.uint8)
    folded = np.full(0x10000, UNSURE, np.uint8)
    lower = np.arange(0x10000, dtype=np.uint32)
    for point in range(0x10000):
        char = chr(point)
        now = unicodedata.category(char)
        kind = _kind(now)
        if point in _BLANKS:
            plain[point] = folded[point] = SPACE
        elif kind != UNSURE and kind == _kind(old.category(char)):
            plain[point] = kind
            small = char.lower()
            # Marks and conjoining letters may combine with what stands before them.
            if now[0] != "M" and not 0x1100 <= point < 0x1200 and len(small) == 1 and unicodedata.normalize("NFC", char) == char:
                folded[point] = kind
                lower[point] = ord(small)
    return plain, folded, lower


@cache
def _values() -> np.ndarray:
    return W.mix(np.arange(1, 0x10001, dtype=np.uint64))


class Splitter:
    """Pieces of slices of texts. ``folds`` is the lower-casing kind that drops white space and parts digits."""

    def __init__(self, folds: bool, special: tuple[str, ...]):
        self.folds = folds
        self.special = [s.encode() for s in special]

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        """(hash of each piece, where each text's pieces begin, ``text_of(i)`` of piece i, texts left to the library)."""
        raw = data.tobytes()
        points = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
        lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        if lead[-1] != len(points):  # bytes that are no UTF-8
            return None
        at = lead[offsets]
        plain, folded, lower = _tables()
        low = np.minimum(points, 0xFFFF)
        kind = (folded if self.folds else plain)[low]
        kind[points > 0xFFFF] = UNSURE
        whole = set((np.searchsorted(at, np.flatnonzero(kind == UNSURE), "right") - 1).tolist())
        for mark in self.special:
            found = raw.find(mark)
            while found >= 0:
                whole.add(int(np.searchsorted(offsets, found, "right")) - 1)
                found = raw.find(mark, found + 1)
        if self.folds:
            low = lower[low]
        n = len(points)
        if n == 0:
            return np.zeros(0, np.uint64), np.zeros(len(at), np.int64), None, whole

        start = np.ones(n, bool)
        start[1:] = kind[1:] != kind[:-1]
        first = np.zeros(n, bool)  # of a text
        first[at[:-1][at[:-1] < n]] = True
        start |= first
        glued = np.zeros(n, bool)  # begins with the blank before it
        if self.folds:
            start |= kind == NUMBER
        else:
            last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~first[1:])
            start[last] = True
            glued[last[low[last] == 0x20] + 1] = True
            start &= ~glued
        # An apostrophe by itself takes s, t, m, d, re, ve or ll after it.
        quote = np.flatnonzero((low == 0x27) & start)
        quote = quote[quote + 1 < n]
        quote = quote[(kind[quote + 1] == LETTER) & ~first[quote + 1]]
        if len(quote):
            one = low[quote + 1]
            after = np.minimum(quote + 2, n - 1)
            two = np.where((quote + 2 < n) & ~first[after] & (kind[after] == LETTER), low[after], 0)
            short = np.isin(one, [ord(c) for c in "stmd"])
            long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
            start[quote[short | long] + 1] = False
            for which, size in ((short, 2), (long & ~short, 3)):
                cut = quote[which] + size
                start[cut[cut < n]] = True
        starts = np.flatnonzero(start)
        ends = np.append(starts[1:], n)
        if self.folds:
            solid = kind[starts] != SPACE
            starts, ends = starts[solid], ends[solid]
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        with np.errstate(over="ignore"):
            up, down = W._Powers.to(n)
            np.cumsum(_values()[low] * up, out=sums[1:])
            piece = W.mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * W._BASE)
        if not self.folds:
            low = points
        text_of = lambda i: low[starts[i] : ends[i]].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        return piece, np.searchsorted(starts, at), text_of, whole


@cache
def library(path: str):
    """The tokenizer of a worker; the file must be at ``path`` on every machine."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def encode(path: str, texts: list[str]) -> list[list[int]]:
    return [e.ids for e in library(path).encode_batch(texts, add_special_tokens=False)] if texts else []


class Cache:
    """Ids of pieces by hash, kept by a worker between batches; it starts anew beyond ``limit`` pieces."""

    def __init__(self, path: str, limit: int = 1_500_000):
        self.path, self.limit = path, limit
        self.clear()

    def clear(self) -> None:
        self.hash, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def find(self, piece: np.ndarray, text_of) -> np.ndarray:
        """Entry of each piece; unknown pieces are encoded first."""
        if len(self.hash) > self.limit:
            self.clear()
        unique, at, inverse = np.unique(piece, return_index=True, return_inverse=True)
        spot = np.searchsorted(self.hash, unique)
        known = spot < len(self.hash)
        known[known] = self.hash[spot[known]] == unique[known]
        new = np.flatnonzero(~known)
        if len(new):
            found = encode(self.path, [text_of(i) for i in at[new]])
            size = np.array([len(x) for x in found], np.int64)
            flat = np.fromiter((y for x in found for y in x), np.uint32, int(size.sum()))
            if self.used + len(flat) > len(self.ids):
                self.ids = np.concatenate([self.ids[: self.used], np.zeros(max(len(flat), self.used), np.uint32)])
                self.ids = np.concatenate([self.ids, np.zeros(len(flat), np.uint32)])
            self.ids[self.used : self.used + len(flat)] = flat
            begin = self.used + np.cumsum(size) - size
            self.used += len(flat)
            self.hash = np.insert(self.hash, spot[new], unique[new])
            self.place = np.insert(self.place, spot[new], len(self.begin) + np.arange(len(new)))
            self.begin, self.size = np.concatenate([self.begin, begin]), np.concatenate([self.size, size])
            spot = np.searchsorted(self.hash, unique)
        return self.place[spot][inverse]


@cache
def worker_cache(path: str) -> Cache:
    return Cache(path)


@cache
def splitter(path: str) -> Splitter:
    """The splitter that fits the file's own rules; other kinds of files are refused."""
    import json

    with open(path, encoding="utf-8") as f:
        rules = json.load(f)
    special = tuple(t["content"] for t in rules["added_tokens"])
    kinds = (rules["normalizer"] or {}).get("type"), rules["pre_tokenizer"]["type"]
    if kinds == (None, "ByteLevel") and rules["pre_tokenizer"]["use_regex"] and not rules["pre_tokenizer"]["add_prefix_space"]:
        return Splitter(False, special)
    if kinds == ("Sequence", "Sequence"):
        return Splitter(True, special)
    raise ValueError(f"no splitter for {kinds}")


def slices(path: str, column: pa.Array) -> Iterator[tuple]:
    """Per slice of a batch: number of the first text, pieces, where each text's begin, ``text_of``, {text: its ids by the library}."""
    split = splitter(path)
    for first, data, offsets in W.slices(column):
        found = split(data, offsets)
        if found is None:
            piece, begins, text_of, whole = np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), None, range(len(offsets) - 1)
        else:
            piece, begins, text_of, whole = found
        whole = sorted(whole)
        texts = [data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace") for i in whole]
        yield first, piece, begins, text_of, dict(zip(whole, encode(path, texts)))


def token_ids(path: str, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per slice: number of the first text, ids of all its texts in order, where each text's ids begin."""
    cached = worker_cache(path)
    for first, piece, begins, text_of, whole in slices(path, column):
        entry = cached.find(piece, text_of) if len(piece) else np.zeros(0, np.int64)
        size = cached.size[entry] if len(entry) else np.zeros(0, np.int64)
        total = np.concatenate([[0], np.cumsum(size)])
        flat = cached.ids[np.repeat(cached.begin[entry] - total[:-1], size) + np.arange(total[-1])] if len(entry) else np.zeros(0, np.uint32)
        at = total[begins]
        if whole:
            parts = [np.array(whole[i], np.uint32) if i in whole else flat[at[i] : at[i + 1]] for i in range(len(at) - 1)]
            flat = np.concatenate(parts)
            at = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        yield first, flat, at
