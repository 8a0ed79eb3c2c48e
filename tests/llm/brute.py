"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations
from math import log10

#: Counts above this are not discounted.
TOP = 5

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, size):
    w = words(text)
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def groups(texts, percent, size):
    """Smallest reachable id of each id of {id: text}."""
    sets = {i: shingles(t, size) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(set)
    for i, s in sets.items():
        for g in s:
            holders[g].add(i)
    for a, b in {pair for ids in holders.values() for pair in combinations(sorted(ids), 2)}:
        common = len(sets[a] & sets[b])
        if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: root(i) for i in sets}


def repeated_words(w):
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    return len({p for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for p in (i, i + 1, i + 2)})


def good_turing(of):
    """Katz's discount factor of each count from 1 to TOP, from how many items occur how often; half a count less where it is undefined."""
    half = {r: (r - 0.5) / r for r in range(1, TOP + 1)}
    if not all(of.get(r) for r in range(1, TOP + 2)):
        return half
    a = (TOP + 1) * of[TOP + 1] / of[1]
    if a >= 1:
        return half
    d = {r: ((r + 1) * of[r + 1] / of[r] / r - a) / (1 - a) for r in range(1, TOP + 1)}
    return d if all(0 < x < 1 for x in d.values()) else half


class Katz:
    """The model of ``katz.language_model`` from dictionaries."""

    def __init__(self, texts):
        count = Counter(w for t in texts for w in words(t))
        self.count = count
        count["</s>"] = len(texts)
        self.total, self.distinct = sum(count.values()), len(count)
        self.d = good_turing(Counter(count.values()))
        left = self.total - sum(self.cut(c, self.d) for c in count.values())
        self.mass = self.total if left > 1e-9 else self.total + 1
        self.unknown = (left if left > 1e-9 else 1) / self.mass
        self.after = defaultdict(Counter)
        for t in texts:
            w = ["<s>", *words(t), "</s>"]
            for a, b in zip(w, w[1:]):
                self.after[a][b] += 1
        self.d2 = good_turing(Counter(c for follow in self.after.values() for c in follow.values()))

    @staticmethod
    def cut(c, d):
        return c if c > TOP else c * d[c]

    def word(self, w):
        return self.cut(self.count[w], self.d) / self.mass if self.count.get(w) else self.unknown

    def next(self, before, word):
        follow = self.after.get(before)
        if not follow:
            return self.word(word)
        total, held = sum(follow.values()), sum(self.cut(c, self.d2) for c in follow.values())
        unseen = 1 - sum(self.word(w) for w in follow)
        if unseen <= 1e-12:
            return follow.get(word, 0) / total
        mass, spare = (total, total - held) if total - held > 1e-9 else (total + 1, 1)
        return self.cut(follow[word], self.d2) / mass if word in follow else spare / mass / unseen * self.word(word)

    def score(self, text):
        w = ["<s>", *words(text), "</s>"]
        return sum(log10(self.next(a, b)) for a, b in zip(w, w[1:]))

    def base(self, text):
        return sum(log10((self.count[w] + 1) / (self.total + self.distinct + 1)) for w in [*words(text), "</s>"])


def fold(doc_id, divisor):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % divisor
