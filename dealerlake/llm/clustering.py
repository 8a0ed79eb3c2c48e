"""Centroid clustering with a LAESA table: distances to fixed pivots, stored once, rule out most centroids before an exact distance is taken."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealerlake.llm import vectors as V
from dealerlake.llm.store import saved

#: Vectors that serve as pivots, and the sample of vectors they are picked from.
PIVOTS = 8
PIVOT_SAMPLE = 512
#: Squared lengths stay below 2^60, so that squared distances fit a long.
LARGEST = 60


def _prepared(size: int, factor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, found = V.scaled(batch.column("vector"), factor, LARGEST)
            kept = [(i, v) for i, v in zip(places, found) if len(v) == size]
            rows = pa.array([i for i, _ in kept], pa.int64())
            yield pa.record_batch([batch.column("vec_id").take(rows), pa.array([V.packed(v) for _, v in kept], pa.binary())], names=["vec_id", "vector"])

    return run


def _pivots(sample: np.ndarray, number: int) -> np.ndarray:
    """Vectors far from each other: each next one is farthest from those picked before."""
    picked = [0]
    near = V.squares(sample, np.broadcast_to(sample[0], sample.shape)).astype(float)
    while len(picked) < min(number, len(sample)) and near.max() > 0:
        picked.append(int(near.argmax()))
        near = np.minimum(near, V.squares(sample, np.broadcast_to(sample[picked[-1]], sample.shape)))
    return sample[picked]


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([V.squares(rows, np.broadcast_to(p, rows.shape)) for p in pivots], 1).astype(float))


def _tabled(pivots: np.ndarray):
    """The pivot table: each vector's distances to the pivots, next to the vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                rows = V.matrix(batch.column("vector").to_pylist(), pivots.shape[1])
                table = [r.astype("<f8").tobytes() for r in _distances(rows, pivots)]
                yield pa.record_batch([batch.column("vec_id"), batch.column("vector"), pa.array(table, pa.binary())], names=["vec_id", "vector", "pivots"])

    return run


@dataclass
class Nearest:
    """Centroids, and their distances to the pivots."""

    centroids: np.ndarray
    table: np.ndarray

    def of(self, rows: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per row the nearest centroid, the smaller number on ties; its squared distance; and how many distances were taken.

        |d(x, p) - d(c, p)| <= d(x, c) for each pivot p. A centroid whose bound passes the best distance so far can neither win nor tie. Bounds
        are lowered by more than floats may be off.
        """
        bound = np.zeros((len(rows), len(self.centroids)))
        for p in range(table.shape[1]):
            np.maximum(bound, np.abs(table[:, p, None] - self.table[None, :, p]), out=bound)
        bound = np.maximum(bound * (1 - 1e-12) - 1e-12 * table.max(1, initial=0)[:, None] - 1e-9, 0.0) ** 2
        first = bound.argmin(1)
        best, distance = first.copy(), V.squares(rows, self.centroids[first])
        taken = np.ones(len(rows), np.int32)
        for c in range(len(self.centroids)):
            # As whole numbers, the bound rounded down: distances beyond 2^53 are no exact floats.
            open_ = np.flatnonzero((first != c) & (np.floor(bound[:, c] * (1 - 1e-15)).astype(np.int64) <= distance))
            if len(open_):
                found = V.squares(rows[open_], np.broadcast_to(self.centroids[c], (len(open_), rows.shape[1])))
                taken[open_] += 1
                better = (found < distance[open_]) | ((found == distance[open_]) & (c < best[open_]))
                best[open_[better]], distance[open_[better]] = c, found[better]
        return best, distance, taken


def _assigned(batches: Iterator[pa.RecordBatch], near: Nearest):
    for batch in batches:
        if len(batch):
            rows = V.matrix(batch.column("vector").to_pylist(), near.centroids.shape[1])
            table = np.frombuffer(b"".join(batch.column("pivots").to_pylist()), "<f8").reshape(len(batch), -1)
            yield batch, rows, near.of(rows, table)


def _sums(sent):
    """Per task, each cluster's size and sums of components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = sent.value
        size, total = np.zeros(len(near.centroids), np.int64), np.zeros(near.centroids.shape, np.int64)
        for _, rows, (best, _, _) in _assigned(batches, near):
            size += np.bincount(best, minlength=len(size))
            for c in np.unique(best):
                total[c] += rows[best == c].astype(np.int64).sum(0)
        held = np.flatnonzero(size)
        width = total.shape[1]
        yield pa.record_batch(
            [
                pa.array(np.repeat(held, width).astype(np.int32)),
                pa.array(np.tile(np.arange(width), len(held)).astype(np.int32)),
                pa.array(np.repeat(size[held], width)),
                pa.array(total[held].ravel()),
            ],
            names=["cluster", "component", "size", "total"],
        )

    return run


def _found(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, (best, distance, taken) in _assigned(batches, sent.value):
            columns = [batch.column("vec_id"), pa.array(best.astype(np.int32)), pa.array(distance), pa.array(taken)]
            yield pa.record_batch(columns, names=["vec_id", "cluster", "distance", "n_distances"])

    return run


def _moved(near: Nearest, table: DataFrame, pivots: np.ndarray) -> Nearest:
    """Each centroid replaced by the floor of its vectors' mean, in whole numbers; empty ones stay. The driver gets a row per centroid and component."""
    sent = table.sparkSession.sparkContext.broadcast(near)
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    sums = table.mapInArrow(_sums(sent), "cluster int, component int, size long, total long").groupBy("cluster", "component").agg(exact("size"), exact("total"))
    centroids = near.centroids.copy()
    for r in sums.collect():
        centroids[r["cluster"], r["component"]] = int(r["total"]) // int(r["size"])
    return Nearest(centroids, _distances(centroids, pivots))


def _first_by_hash(kept: DataFrame, rows: int, seed: int, k: int) -> list[bytes]:
    """The vectors with the smallest hashes, some ``rows`` of them, ``k`` at least if there are so many.

    Only hashes below a share of all are looked at, so that tasks send the driver little however many they are; the share grows while too few are found.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    hashed = kept.select("vector", digest.alias("h"))
    count = kept.count()
    share = 2 * rows / max(count, 1)
    while True:
        # The first 13 hexadecimal digits are 52 bits.
        low = hashed.where(F.conv(F.substring("h", 1, 13), 16, 10).cast("double") <= share * 2.0**52) if share < 1 else hashed
        found = [bytes(r["vector"]) for r in low.orderBy("h", "vector").limit(max(rows, k)).collect()]
        if share >= 1 or len(found) >= k:
            return found
        share *= 8


def clusters(embeddings: DataFrame, k: int = 16, rounds: int = 3, size: int = 64, factor: int = 64, seed: int = 1) -> DataFrame:
    """The cluster of each usable row of ``embeddings`` (vec_id, embedding): vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, n_distances.

    Usable are vectors of ``size`` finite components; those, as integers floor(``factor`` * x), are clustered. (Vectors longer than
    2^30 as integers are left out: their squared distances fit no long.) Centroids start as the ``k`` vectors with the smallest
    sha256 of "seed:vec_id", all vectors if fewer, and move ``rounds`` times to the floor of their vectors' mean. Distances are squared and exact; of equally
    near centroids the smaller number wins. ``distance`` is the row's, the inertias its sums over the cluster and over all;
    centroid_sha256 is of the final components as decimals joined by commas. ``n_distances`` counts the exact distances the last assignment took
    for the row, of ``k``.

    Vectors and their distances to the pivots are written once. Each round streams that table past the centroids (``k`` vectors, broadcast), and
    sums come back per cluster and component, so a cluster with a third of all rows costs no more than others. Rows with a null id count, under
    the empty text in the hash; repeated rows count each; equal hashes go by components. Further columns are left out. An empty table gives an empty one.
    """
    spark = embeddings.sparkSession
    source = V.checked(embeddings, "vec_id", "embedding").select(F.col("vec_id").cast("long").alias("vec_id"), V.as_doubles("embedding").alias("vector"))
    kept = source.mapInArrow(_prepared(size, factor), "vec_id long, vector binary")
    sample = _first_by_hash(kept, PIVOT_SAMPLE, seed, k)
    out = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, n_distances int"
    if not sample:
        return spark.createDataFrame([], out)
    # Equal hashes mean equal ids; such rows come by their bytes, as good as any order.
    drawn = V.matrix(sample, size)
    pivots = _pivots(drawn, PIVOTS)
    table = saved(kept.mapInArrow(_tabled(pivots), "vec_id long, vector binary, pivots binary"))
    near = Nearest(drawn[:k], _distances(drawn[:k], pivots))
    for _ in range(rounds):
        near = _moved(near, table, pivots)
    assigned = saved(table.mapInArrow(_found(spark.sparkContext.broadcast(near)), "vec_id long, cluster int, distance long, n_distances int"))
    per = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    every = sum(int(r["total"]) for r in per)
    digest = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in near.centroids]
    fits = lambda n: n if n < 1 << 63 else None
    final = spark.createDataFrame(
        [(r["cluster"], fits(int(r["total"])), fits(every), digest[r["cluster"]]) for r in per],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return assigned.join(final, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "n_distances")
