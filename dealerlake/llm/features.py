"""Numeric features of whole texts, computed for Arrow batches at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from dealerlake.llm import words as W

_UPPER, _LOWER, _DIGIT, _SYMBOL, _STOP, _BANG, _QUOTE, _WIDE = range(8)
_KIND = np.full(256, 255, np.uint8)
for _kind, _chars in (
    (_UPPER, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    (_LOWER, "abcdefghijklmnopqrstuvwxyz"),
    (_DIGIT, "0123456789"),
    (_SYMBOL, "#*$%&|<>@{}[]\\^~_=+"),
    (_STOP, ".,;:"),
    (_BANG, "!?"),
    (_QUOTE, "\"'()-/"),
):
    _KIND[[ord(c) for c in _chars]] = _kind
_KIND[0xC0:] = _WIDE  # the first byte of a longer character

NAMES = (
    "log_words log_lines word_length upper digits symbols stops bangs quotes wide symbol_ends stop_ends bang_ends "
    "capital_starts long_words distinct_words distinct_triples same_as_last repeated_lines words_per_line"
).split()


def _distinct(key: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """How many different keys each text has."""
    text = np.repeat(np.arange(len(begins) - 1, dtype=np.uint64), np.diff(begins))
    both = np.sort((text << np.uint64(40)) | (key >> np.uint64(24)))
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    return np.bincount((both[new] >> np.uint64(40)).astype(np.int64), minlength=len(begins) - 1)


def _per_text(flag: np.ndarray, begins: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flag)])
    return total[begins[1:]] - total[begins[:-1]]


def text_features(column: pa.Array) -> np.ndarray:
    """One row of NAMES per text. Nulls are empty texts, whose features are all 0."""
    out = []
    for _, data, offsets in W.slices(column):
        n = len(offsets) - 1
        starts, ends = W.bounds(data, offsets)
        begins = np.searchsorted(starts, offsets)
        n_words = np.diff(begins)
        some = np.maximum(n_words, 1)
        kind = _KIND[data]
        chars = _per_text((data & 0xC0) != 0x80, offsets)
        spans = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        length = spans[ends] - spans[starts]
        counts = [_per_text(kind == k, offsets) for k in range(8)]
        letters = np.maximum(counts[_UPPER] + counts[_LOWER] + counts[_WIDE], 1)
        solid = np.maximum(_per_text(length, begins), 1)
        last = kind[ends - 1] if len(ends) else np.zeros(0, np.uint8)
        head = kind[starts] if len(starts) else last
        word = W.hashes(data, starts, ends)
        triple, triples = W.shingles(word, begins, 3)
        same = np.zeros(len(word), bool)
        same[1:] = word[1:] == word[:-1]
        same[begins[:-1][n_words > 0]] = False
        # Lines are words for which only the line feed stands between.
        feed = np.zeros(256, bool)
        feed[0x0A] = True
        line_starts, line_ends = W.bounds(data, offsets, feed)
        lines = np.searchsorted(line_starts, offsets)
        n_lines = np.diff(lines)
        different = _distinct(W.hashes(data, line_starts, line_ends), lines)
        columns = [
            np.log1p(n_words),
            np.log1p(n_lines),
            _per_text(length, begins) / some,
            counts[_UPPER] / letters,
            counts[_DIGIT] / solid,
            counts[_SYMBOL] / solid,
            counts[_STOP] / solid,
            counts[_BANG] / solid,
            counts[_QUOTE] / solid,
            counts[_WIDE] / letters,
            _per_text(last == _SYMBOL, begins) / some,
            _per_text(last == _STOP, begins) / some,
            _per_text(last == _BANG, begins) / some,
            _per_text(head == _UPPER, begins) / some,
            _per_text(length > 12, begins) / some,
            _distinct(word, begins) / some,
            _distinct(triple, triples) / np.maximum(np.diff(triples), 1),
            _per_text(same, begins) / some,
            1 - different / np.maximum(n_lines, 1),
            n_words / np.maximum(n_lines, 1),
        ]
        rows = np.stack([np.asarray(c, float) for c in columns], 1)
        rows[chars == 0] = 0.0
        out.append(rows.reshape(n, len(NAMES)))
    return np.concatenate(out) if out else np.zeros((0, len(NAMES)))
