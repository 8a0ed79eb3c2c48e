"""Toxicity: cumulative-link ordinal regression of severity grades on sparse text features."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealerlake.llm import words as W
from dealerlake.llm.labelled import labelled_sample
from dealerlake.llm.store import remainder, saved

#: Labelled documents the model is fitted on at most, and words it knows at most.
SAMPLE = 20_000
WORDS = 8_192
#: Documents of the sample a word must occur in.
LEAST = 5
#: Times the largest chance difference that a word must show; texts that share passages are no independent draws.
MARGIN = 1.5
#: Bytes of word beginnings that are features besides whole words.
PREFIXES = (4, 5, 6)
STEPS = 400
RATE = 0.1
#: Pull of the weights towards 0, per row.
RIDGE = 1e-5

#: Words here are runs of letters and digits: every byte but ASCII marks and blanks.
_BREAK = np.ones(256, bool)
_BREAK[0x80:] = False
for _a, _b in (("0", "9"), ("A", "Z"), ("a", "z")):
    _BREAK[ord(_a) : ord(_b) + 1] = False


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def sparse_features(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per slice: number of the first text, hashes of each text's words and word beginnings, and where a text's begin.

    A-Z are lower-cased. Beginnings of PREFIXES bytes stand for words with many endings.
    """
    for first, data, offsets in W.slices(column):
        low = W.LOWER[data]
        starts, ends = W.bounds(data, offsets, _BREAK)
        found, at = [W.hashes(low, starts, ends)], [starts]
        for size in PREFIXES:
            long = ends - starts > size
            found.append(W.mix(W.hashes(low, starts[long], starts[long] + size) ^ np.uint64(size)))
            at.append(starts[long])
        at = np.concatenate(at)
        order = np.argsort(at, kind="stable")
        yield first, np.concatenate(found)[order], np.searchsorted(at[order], offsets)


@dataclass
class OrdinalModel:
    """P(grade >= k) = sigmoid(weights . features - thresholds[k - 1]), the same weights for every k."""

    words: np.ndarray  # hashes, ascending
    weights: np.ndarray
    thresholds: np.ndarray  # ascending

    def at_least(self, word: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """A row per text, a column per grade above 0."""
        n, total = len(begins) - 1, np.zeros(len(begins) - 1)
        if len(self.words) and len(word):
            spot = np.minimum(np.searchsorted(self.words, word), len(self.words) - 1)
            hit = np.flatnonzero(self.words[spot] == word)
            text = np.searchsorted(begins, hit, "right") - 1
            once = np.unique(text * len(self.words) + spot[hit])
            total = np.bincount(once // len(self.words), self.weights[once % len(self.words)], n)
        return _sigmoid(total[:, None] - self.thresholds[None])


def _positive(label: np.ndarray) -> np.ndarray:
    return np.floor(label + 0.5) > 0


def _rates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of a batch have each feature, and how many of those are positive."""
    for batch in batches:
        positive = _positive(batch.column("label").to_numpy(zero_copy_only=False))
        for first, word, begins in sparse_features(batch.column("text")):
            texts = [np.unique(word[a:b]) for a, b in zip(begins[:-1], begins[1:])]
            flat = np.concatenate(texts)
            mark = np.repeat(positive[first : first + len(texts)], [len(t) for t in texts])
            unique, inverse, n = np.unique(flat, return_inverse=True, return_counts=True)
            hits = np.bincount(inverse, mark, len(unique)).astype(np.int64)
            yield pa.record_batch([pa.array(unique.view(np.int64)), pa.array(n), pa.array(hits)], names=["word", "n", "hits"])


def lexicon(drawn: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Features (hashes ascending) whose rate differs between positive and other texts of ``drawn`` (label, text), and by how many standard errors.

    The difference must exceed what the largest of so many would reach by chance, so that words seen in a few
    texts only don't count. Counted in Spark; at most WORDS come to the driver.
    """
    texts, positives = drawn.agg(F.count("*"), F.sum(F.floor(F.col("label") + 0.5).cast("long").cast("boolean").cast("long"))).first()
    none = np.zeros(0, np.uint64), np.zeros(0)
    if not texts or positives in (None, 0, texts):
        return none
    rates = drawn.select("label", "text").mapInArrow(_rates, "word long, n long, hits long")
    rates = saved(rates.groupBy("word").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).where(F.col("n") >= LEAST))
    share = positives / texts
    least = MARGIN * float(np.sqrt(2 * np.log(max(rates.count(), 2))))
    z = (F.col("hits") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share))
    rows = rates.withColumn("z", z).where(F.abs("z") > least).orderBy(F.desc(F.abs("z")), "word").limit(WORDS).collect()
    if not rows:
        return none
    word, z = np.array([r["word"] for r in rows], np.int64).view(np.uint64), np.array([r["z"] for r in rows])
    order = np.argsort(word)
    return word[order], z[order]


def _hits(known: np.ndarray):
    """Places in ``known`` of each text's distinct features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, word, begins in sparse_features(batch.column("text")):
                spot = np.minimum(np.searchsorted(known, word), max(len(known) - 1, 0))
                hit = known[spot] == word if len(known) else np.zeros(len(word), bool)
                out += [np.unique(spot[a:b][hit[a:b]]) for a, b in zip(begins[:-1], begins[1:])]
            yield pa.record_batch([batch.column("doc_id"), batch.column("label"), pa.array(out, pa.list_(pa.int64()))], names=["doc_id", "label", "hits"])

    return run


def grades_of(texts: list[np.ndarray], z: np.ndarray, labels: np.ndarray, levels: int) -> np.ndarray:
    """Severity grades for yes/no labels: 0 for no, then 1 to ``levels`` by quantiles of how many telling words a text has.

    ``texts`` has each text's places in the lexicon, of which those with a positive ``z`` are telling. Labels that are
    grades already (some above 1) are rounded and kept.
    """
    grade = np.floor(labels + 0.5).astype(int)
    if levels <= 1 or grade.max(initial=0) > 1 or grade.min(initial=0) == grade.max(initial=0):
        return grade
    hits = np.array([(z[t] > 0).sum() for t in texts])
    cuts = np.quantile(hits[grade == 1], np.arange(1, levels) / levels)
    return np.where(grade == 1, 1 + np.searchsorted(cuts, hits, "left"), 0)


def fit(known: np.ndarray, texts: list[np.ndarray], grade: np.ndarray) -> OrdinalModel:
    """Learns from each text's places in ``known`` and its grade. One grade only gives a constant."""
    n, top = len(texts), int(grade.max(initial=0))
    share = [((grade >= k).sum() + 0.5) / (n + 1) for k in range(1, max(top, 1) + 1)]
    thresholds = np.array([-np.log(s / (1 - s)) for s in share])
    if n == 0 or grade.min() == grade.max():
        return OrdinalModel(np.zeros(0, np.uint64), np.zeros(0), thresholds)
    word = np.concatenate(texts).astype(np.int64)
    text = np.repeat(np.arange(n), [len(t) for t in texts])
    weights = np.zeros(len(known))
    # Thresholds as a first one and logs of the steps, so that they stay in order.
    first, steps = thresholds[0], np.log(np.maximum(np.diff(thresholds), 1e-2))
    mean = [np.zeros_like(weights), 0.0, np.zeros_like(steps)]
    size = [np.zeros_like(weights), 0.0, np.zeros_like(steps)]
    for step in range(1, STEPS + 1):
        cuts = first + np.concatenate([[0.0], np.cumsum(np.exp(steps))])
        score = np.bincount(text, weights[word], n)
        # P(grade = g) = upper - lower, with upper = P(grade >= g), lower = P(grade >= g + 1).
        at_least = np.concatenate([np.ones((n, 1)), _sigmoid(score[:, None] - cuts[None]), np.zeros((n, 1))], 1)
        slope = at_least * (1 - at_least)
        row = np.arange(n)
        p = np.maximum(at_least[row, grade] - at_least[row, grade + 1], 1e-12)
        by_score = (slope[row, grade] - slope[row, grade + 1]) / p
        g_weights = np.bincount(word, by_score[text], len(known)) / n - RIDGE * weights
        g_cuts = np.zeros(top + 2)
        np.add.at(g_cuts, grade, -slope[row, grade] / p)
        np.add.at(g_cuts, grade + 1, slope[row, grade + 1] / p)
        g_cuts = g_cuts[1 : top + 1] / n
        g_steps = np.cumsum(g_cuts[:0:-1])[::-1] * np.exp(steps) if top > 1 else np.zeros(0)
        moves = []
        for i, g in enumerate((g_weights, g_cuts.sum(), g_steps)):
            mean[i] = 0.9 * mean[i] + 0.1 * g
            size[i] = 0.99 * size[i] + 0.01 * g * g
            moves.append(RATE * (mean[i] / (1 - 0.9**step)) / (np.sqrt(size[i] / (1 - 0.99**step)) + 1e-8))
        weights, first, steps = weights + moves[0], first + moves[1], steps + moves[2]
    return OrdinalModel(known, weights, first + np.concatenate([[0.0], np.cumsum(np.exp(steps))]))


def learn(docs: DataFrame, labels: DataFrame, label: str, sample: int, levels: int) -> OrdinalModel:
    """Fits the model on at most ``sample`` labelled documents of ``docs`` (doc_id, text)."""
    drawn = saved(labelled_sample(docs, labels, label, sample).select("doc_id", "label", "text"))
    known, z = lexicon(drawn)
    rows = drawn.mapInArrow(_hits(known), "doc_id long, label double, hits array<long>").collect()
    rows = sorted((r["doc_id"], r["label"], tuple(r["hits"])) for r in rows)
    texts = [np.array(r[2], np.int64) for r in rows]
    return fit(known, texts, grades_of(texts, z, np.array([r[1] for r in rows], float), levels))


def _scores(model: OrdinalModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.at_least(word, begins) for _, word, begins in sparse_features(batch.column("text"))]
            p = np.concatenate(found) if found else np.zeros((0, len(model.thresholds)))
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(p[:, 0]), pa.array(p.sum(axis=1)), pa.array((p >= 0.5).sum(axis=1).astype(np.int32))],
                names=["doc_id", "held_out", "score", "severity", "grade"],
            )

    return run


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, levels: int = 3) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, severity, grade, toxic.

    The model gives P(grade >= k) for every grade k from one weighted sum over the text's distinct words and word
    beginnings, and one threshold per grade. ``score`` is P(grade >= 1), ``severity`` the expected grade, ``grade`` the highest with
    P(grade >= k) >= 0.5, ``toxic`` whether that is 1 or more. Whole texts are scored.

    Labels are ``labels.toxic``: grades, or yes and no, which ``grades_of`` turns into ``levels`` grades. Documents
    whose crc32(doc_id) mod 3 is not 1 teach, ``sample`` of them at most, drawn by a hash of the id.

    Null and empty texts have no words, and the score that the thresholds alone give. Labels of one document are averaged and rounded.
    Without labels, or with one grade only, all scores are a constant. Rows that repeat an id are each
    scored. An empty table gives an empty one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    fold = remainder(F.col("doc_id"), 3)
    model = learn(docs.where(fold != 1), labels.where(remainder(F.col("doc_id"), 3) != 1), "toxic", sample, levels)
    scored = docs.select("doc_id", (fold == 1).alias("held_out"), "text").mapInArrow(
        _scores(model), "doc_id long, held_out boolean, score double, severity double, grade int"
    )
    return scored.withColumn("toxic", F.col("grade") >= 1)
