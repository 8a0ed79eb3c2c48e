"""Quality classifier: a generalised additive model with pairwise terms, learned by cyclic boosting of shallow trees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealerlake.llm.features import NAMES, text_features
from dealerlake.llm.labelled import labelled_sample
from dealerlake.llm.store import remainder

#: Labelled rows the model is fitted on at most.
SAMPLE = 20_000
BINS = 48
PAIR_BINS = 12
PAIRS = 8
ROUNDS = 150
PAIR_ROUNDS = 60
RATE = 0.1
#: Added to a leaf's weight; least rows' weight in a leaf.
RIDGE = 1.0
LEAF = 2.0


def _odds(p: float) -> float:
    return float(np.log(p / (1 - p)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _gain(g, h):
    return g * g / (h + RIDGE)


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Best place to cut a row of bins in two, and what it gains."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = np.where((hl >= LEAF / 10) & (hr >= LEAF / 10), _gain(gl, hl) + _gain(gr, hr) - _gain(g.sum(), h.sum()), 0.0)
    best = int(np.argmax(gain)) if len(gain) else 0
    return (float(gain[best]), best + 1) if len(gain) else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray, splits: int = 3) -> np.ndarray:
    """Value of each bin under a tree of at most ``splits`` cuts, the most useful cut first."""
    parts = [(0, len(g))]
    for _ in range(splits):
        found = [(*_cut(g[a:b], h[a:b]), i) for i, (a, b) in enumerate(parts)]
        gain, at, i = max(found)
        if gain <= 1e-9:
            break
        a, b = parts[i]
        parts[i : i + 1] = [(a, a + at), (a + at, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Table of a tree that cuts one feature, then the other on each side; and what it gains."""
    best, table = 0.0, np.zeros_like(g)
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        for cut in range(1, len(a)):
            gain, here = -_gain(g.sum(), h.sum()), np.zeros_like(a)
            for rows in (slice(0, cut), slice(cut, len(a))):
                gs, hs = a[rows].sum(axis=0), b[rows].sum(axis=0)
                more, at = _cut(gs, hs)
                gain += more + _gain(gs.sum(), hs.sum())
                for columns in (slice(0, at), slice(at, len(gs))) if more > 0 else (slice(None),):
                    here[rows, columns] = gs[columns].sum() / (hs[columns].sum() + RIDGE)
            if gain > best + 1e-9:
                best, table = gain, here.T if turned else here
    return table, best


@dataclass
class AdditiveModel:
    """Edges of each feature's bins, a table per feature, and a table per pair of features on coarser bins."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def bins(self, x: np.ndarray, coarse: bool = False) -> np.ndarray:
        edges = self.pair_edges if coarse else self.edges
        return np.stack([np.searchsorted(e, x[:, i], "right") for i, e in enumerate(edges)], 1) if len(edges) else np.zeros((len(x), 0), int)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        fine = self.bins(x)
        for i, table in enumerate(self.tables):
            total += table[fine[:, i]]
        if self.pairs:
            coarse = self.bins(x, True)
            for i, j, table in self.pairs:
                total += table[coarse[:, i], coarse[:, j]]
        return _sigmoid(total)


def _quantile_edges(column: np.ndarray, bins: int) -> np.ndarray:
    """Between bins; midway between neighbouring values, so that a value is never on an edge."""
    values = np.unique(column)
    if len(values) <= bins:
        return (values[1:] + values[:-1]) / 2
    cuts = np.unique(np.quantile(column, np.arange(1, bins) / bins, method="nearest"))
    at = np.searchsorted(values, cuts)
    at = at[at > 0]
    return (values[at] + values[at - 1]) / 2


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Learns from rows ``x`` with labels ``y`` between 0 and 1. Without rows, or with one class, the score is a constant."""
    base = _odds((y.sum() + 1) / (len(y) + 2))
    if len(y) == 0 or y.min() == y.max():
        return AdditiveModel(base, [], [], [], [])
    width = x.shape[1]
    model = AdditiveModel(
        base, [_quantile_edges(x[:, i], BINS) for i in range(width)], [], [_quantile_edges(x[:, i], PAIR_BINS) for i in range(width)], []
    )
    fine, coarse = model.bins(x), model.bins(x, True)
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(y), base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = _sigmoid(total)
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for i, table in enumerate(model.tables):
            g, h = slopes()
            step = RATE * _tree(np.bincount(fine[:, i], g, len(table)), np.bincount(fine[:, i], h, len(table)))
            table += step
            total += step[fine[:, i]]

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = len(model.pair_edges[i]) + 1, len(model.pair_edges[j]) + 1
        cell = coarse[:, i] * shape[1] + coarse[:, j]
        g, h = slopes()
        return np.bincount(cell, g, shape[0] * shape[1]).reshape(shape), np.bincount(cell, h, shape[0] * shape[1]).reshape(shape), cell

    # The pairs that explain most of what single features leave over.
    gains = sorted(((-_pair_tree(*grid(i, j)[:2])[1], i, j) for i in range(width) for j in range(i)), key=lambda t: t)
    model.pairs = [(i, j, np.zeros((len(model.pair_edges[i]) + 1, len(model.pair_edges[j]) + 1))) for gain, i, j in gains[:PAIRS] if gain < 0]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in model.pairs:
            g, h, cell = grid(i, j)
            step = RATE * _pair_tree(g, h)[0]
            table += step
            total += step.ravel()[cell]
    return model


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.record_batch([batch.column("label"), pa.array(list(text_features(batch.column("text"))), pa.list_(pa.float64()))], names=["label", "x"])


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> AdditiveModel:
    """Fits the model on at most ``sample`` labelled documents of ``docs`` (doc_id, text)."""
    drawn = labelled_sample(docs, labels, label, sample).select("label", "text")
    # In a fixed order, so that sums of floats come out the same in every run.
    rows = sorted((tuple(r["x"]), r["label"]) for r in drawn.mapInArrow(_rows, "label double, x array<double>").collect())
    return fit(np.array([r[0] for r in rows], float).reshape(-1, len(NAMES)), np.array([r[1] for r in rows], float))


def _scores(model: AdditiveModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(text_features(batch.column("text")))
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(score)], names=["doc_id", "held_out", "score"])

    return run


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    ``score`` is the model's probability of ``labels.quality`` = 1 for the whole text; ``predicted`` is 1
    from 0.5 on. Only documents whose crc32(doc_id) mod 3 is not 1 teach, ``sample`` of them at
    most, drawn by a hash of the id. Inputs are numbers about the text alone (``features.NAMES``).

    Features are cut into bins at quantiles of the sample. Trees of a few cuts on one feature at a time
    are added in turn; then trees on the pairs that explain most of the rest. Trees on the
    same feature add up to one table, so a text is scored by one look-up per feature and pair.

    Null and empty texts get the score of features that are all 0. Several labels of a document are averaged.
    Without labels, or with one class only, all scores are the smoothed share of label 1. Rows that repeat
    an id are each scored. An empty table gives an empty one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    fold = remainder(F.col("doc_id"), 3)
    model = learn(docs.where(fold != 1), labels.where(remainder(F.col("doc_id"), 3) != 1), "quality", sample)
    scored = docs.select("doc_id", (fold == 1).alias("held_out"), "text").mapInArrow(_scores(model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _good(model: AdditiveModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.score(text_features(batch.column("text"))) >= 0.5))

    return run


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that ``quality`` predicts to be good, all columns as they are."""
    taught = docs.where(remainder(F.col("doc_id").cast("long"), 3) != 1).select("doc_id", "text")
    model = learn(taught, labels.where(remainder(F.col("doc_id").cast("long"), 3) != 1), "quality", sample)
    return docs.mapInArrow(_good(model), docs.schema)
