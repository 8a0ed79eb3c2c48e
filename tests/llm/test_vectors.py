"""Clustering and hard negatives against plain versions on small tables with edge rows."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dealerlake.llm import clustering, hard_negatives as hard
from dealerlake.llm.clustering import clusters
from dealerlake.llm.hard_negatives import hard_negatives

SCHEMA = "vec_id long, label int, embedding array<double>"
NAN, INF = float("nan"), float("inf")


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("own") for c in ("vector", "row", "cluster", "distance", "rank", "anchor", "pivots")})


def draw(seed, n, size, spread=3):
    """Rows around a few points, with many equal vectors, and rows that take no part."""
    r = np.random.RandomState(seed)
    middles = r.randint(-spread, spread + 1, (5, size))
    rows = []
    for i in range(n):
        vector = (middles[i % 5] + r.randint(-1, 2, size)) / 4
        rows.append((i, int(r.randint(3)), [float(x) for x in vector]))
    rows += [rows[3], rows[7], (None, 1, rows[0][2]), (n, None, rows[1][2]), (n + 1, 1, None), (n + 2, 2, [1.0] * (size - 1))]
    rows += [(n + 3, 1, [NAN] * size), (n + 4, 1, [INF] + [0.0] * (size - 1)), (n + 5, 1, [None] + [0.0] * (size - 1)), (n + 6, 0, []), (n + 7, 0, [1e300] * size)]
    return rows


def integers(vector, factor):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    out = [math.floor(factor * x) for x in vector]
    return out if sum(x * x for x in out) < 2**60 else None


def plain_clusters(rows, k, rounds, size, factor, seed):
    kept = [(i, v) for i, v in ((r[0], integers(r[2], factor)) for r in rows) if v is not None and len(v) == size]
    digest = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    middles = [v for _, v in sorted(kept, key=lambda r: digest(r[0]))[:k]]

    def nearest():
        return [min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(middles)) for _, v in kept]

    for _ in range(rounds):
        at = nearest()
        for c in range(len(middles)):
            own = [v for (_, v), (_, n) in zip(kept, at) if n == c]
            if own:
                middles[c] = [sum(col) // len(own) for col in zip(*own)]
    at = nearest()
    inertia = {c: sum(d for d, n in at if n == c) for c in range(len(middles))}
    return sorted(
        (i is not None, i or 0, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, middles[c])).encode()).hexdigest()) for (i, _), (d, c) in zip(kept, at)
    )


@pytest.mark.parametrize("seed", range(4))
def test_clusters(spark, seed):
    rows = draw(seed, 200, 8)
    out = clusters(table(spark, rows), k=6, rounds=3, size=8, factor=4 << seed, seed=seed).collect()
    found = sorted((r.vec_id is not None, r.vec_id or 0, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in out)
    assert found == plain_clusters(rows, 6, 3, 8, 4 << seed, seed)
    assert all(1 <= r.n_distances <= 6 for r in out) and sum(r.n_distances for r in out) < 5 * len(out)  # the table spares some


def test_few_and_no_vectors(spark):
    rows = draw(0, 20, 8)[:3]
    out = clusters(table(spark, rows), k=16, rounds=0, size=8).collect()
    assert sorted((r.distance, r.cluster) for r in out) == [(0, c) for c in range(3)]
    assert clusters(table(spark, rows), size=9).collect() == []
    assert clusters(table(spark, rows).limit(0)).columns == out[0].__fields__


def test_exact_far_from_zero(spark):
    """Squared distances beyond 2^53, where floats would call them equal."""
    far = float(2**24)
    rows = [(i, 0, [far * (-1) ** i, float(i) / 64, far, far]) for i in range(40)]
    out = clusters(table(spark, rows), k=4, rounds=2, size=4).collect()
    found = sorted((True, r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in out)
    assert found == plain_clusters(rows, 4, 2, 4, 64, 1)


def plain_negatives(rows, every, positives, negatives, low, high, factor):
    kept = [(n, r[0], r[1], integers(r[2], factor)) for n, r in enumerate(rows) if r[1] is not None]
    kept = [r for r in kept if r[3] is not None]
    out = []
    for n, i, label, v in kept:
        if i is None or i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j is None, j or 0, m, k) for m, j, k, w in kept if m != n]
        first = sorted(s for s in scored if s[4] == label)[:positives]
        for p in first:
            fit = sorted(s for s in scored if s[4] != label and low * -p[0] <= 100 * -s[0] <= high * -p[0])[:negatives]
            out += [(i, None if p[1] else p[2], rank, None if s[1] else s[2], -p[0], -s[0]) for rank, s in enumerate(fit, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(4))
def test_negatives(spark, monkeypatch, seed):
    monkeypatch.setattr(hard, "BLOCK", (8, 1000)[seed % 2])
    monkeypatch.setattr(hard, "PER_CLUSTER", (2, 7)[seed // 2])
    monkeypatch.setattr(hard, "LIST", (100, 700)[seed % 2])
    rows = draw(seed, 1500, 6)
    out = hard_negatives(table(spark, rows), every=50, positives=3, negatives=4, low=30, high=90, factor=8)
    assert sorted((tuple(r) for r in out.collect()), key=str) == plain_negatives(rows, 50, 3, 4, 30, 90, 8)


def test_negative_edges(spark):
    rows = draw(1, 20, 6)
    assert hard_negatives(table(spark, rows).limit(0)).collect() == []
    assert hard_negatives(table(spark, rows), every=10**6 + 1).where("anchor_id <> 0").collect() == []
    moved = hard_negatives(table(spark, rows), every=5, relabel=lambda i, label: F.lit(1))
    assert moved.collect() == []  # nothing has another label
    big = [(i, i % 2, [float(2**21 + i), float(2**20)]) for i in range(30)]
    out = hard_negatives(table(spark, big), every=5, factor=256, low=-1000, high=1000)
    assert sorted((tuple(r) for r in out.collect()), key=str) == plain_negatives(big, 5, 5, 10, -1000, 1000, 256)


def test_walks_end_early(spark):
    """Tight clusters: an anchor looks at a part of the candidates only."""
    r = np.random.RandomState(5)
    middles = np.eye(16)
    rows = np.repeat(middles, 500, 0) * 100 + r.randint(-2, 3, (8000, 16))
    anchors = hard.Anchors.of(np.arange(0, 8000, 100), np.arange(0, 8000, 100) % 2, rows[::100])
    best = hard.Best(np.full((80, 1), -(1 << 62)), np.full((80, 1), 1 << 62), 5)
    seen = []
    offer = best.offer
    best.offer = lambda members, score, *rest: (seen.append(score.size), offer(members, score, *rest))
    hard._walk(anchors, best, True, np.arange(8000), np.arange(8000), np.arange(8000) % 2, rows)
    assert sum(seen) < 0.3 * 80 * 8000
    score = rows[::100] @ rows.T
    for a, row in enumerate(anchors.row):
        own = [(-score[row // 100, x], x, x) for x in range(8000) if x % 2 == row % 2 and x != row]
        assert [*zip(-best.held[a, 0][0], best.held[a, 0][1], best.held[a, 0][2])] == sorted(own)[:5]


def test_pivots_are_far_apart():
    sample = np.array([[0.0, 0.0], [1.0, 0.0], [9.0, 0.0], [0.0, 8.0], [0.0, 0.0]])
    assert clustering._pivots(sample, 3).tolist() == [[0, 0], [9, 0], [0, 8]]
    assert len(clustering._pivots(sample[:1].repeat(4, 0), 3)) == 1


def test_first_vectors_by_hash(spark):
    rows = [(i if i % 7 else None if i == 7 else i // 7, bytes([i % 256, i // 256])) for i in range(3000)]
    kept = spark.createDataFrame(rows, "vec_id long, vector binary")
    order = sorted(rows, key=lambda r: (hashlib.sha256(f"9:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    for number, k in ((5, 2), (5, 20), (40, 3)):
        assert clustering._first_by_hash(kept, number, 9, k)[:k] == [v for _, v in order[:k]]
    assert clustering._first_by_hash(kept.limit(0), 5, 9, 3) == []
