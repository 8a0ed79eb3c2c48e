"""Hard negatives with shared lists: anchors of a cluster walk one list of candidates, sorted by an angular upper bound, until nothing further can count."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealerlake.llm import vectors as V
from dealerlake.llm.store import saved
from dealerlake.session import new_folder

#: Anchors that cluster centres are fitted on, at most; a centre for so many anchors of a block; and anchors per block.
SAMPLE = 4096
PER_CLUSTER = 64
BLOCK = 16_384
#: Candidates of one list: a task sorts so many at once for each cluster, and walks them in steps.
LIST = 32_768
STEP = 512
#: Squared lengths stay below 2^62, so that inner products fit a long.
LARGEST = 62
#: Where a null id stands among ids.
_LAST = np.iinfo(np.int64).max


@dataclass
class Anchors:
    """A block of anchors, those of a cluster next to each other."""

    row: np.ndarray
    label: np.ndarray
    vectors: np.ndarray
    length: np.ndarray
    begins: np.ndarray  # of each cluster, and the end
    centres: np.ndarray  # unit vectors
    widest: np.ndarray  # the largest angle between a centre and its anchors

    @classmethod
    def of(cls, row: np.ndarray, label: np.ndarray, vectors: np.ndarray) -> Anchors:
        length = np.linalg.norm(vectors, axis=1)
        unit = vectors / np.maximum(length, 1e-300)[:, None]
        centres = _centres(unit[:: -(-len(unit) // SAMPLE)], max(1, len(unit) // PER_CLUSTER))
        near = (unit @ centres.T).argmax(1)
        order = np.argsort(near, kind="stable")
        used, begins = np.unique(near[order], return_index=True)
        row, label, vectors, length, unit = (x[order] for x in (row, label, vectors, length, unit))
        angle = np.arccos(np.clip((unit * centres[near[order]]).sum(1), -1, 1))
        angle[length == 0] = np.pi
        return cls(row, label, vectors, length, np.append(begins, len(row)), centres[used], np.maximum.reduceat(angle, begins))


def _centres(unit: np.ndarray, number: int, rounds: int = 5) -> np.ndarray:
    """Unit vectors amid those of a bounded sample; their choice changes how long walks are, not what they find."""
    centres = unit[:: max(1, len(unit) // number)][:number].copy()
    for _ in range(rounds):
        near = (unit @ centres.T).argmax(1)
        total = np.zeros_like(centres)
        np.add.at(total, near, unit)
        length = np.linalg.norm(total, axis=1)
        moved = length > 1e-9
        centres[moved] = total[moved] / length[moved, None]
    return centres


class Best:
    """Per anchor and window the ``top`` best candidates so far, by score, then id, then row.

    There is a window for each of an anchor's positives: the scores from ``least`` to ``most``.
    """

    def __init__(self, least: np.ndarray, most: np.ndarray, top: int):
        #: A candidate of a score below ``least`` changes nothing; it rises as places are taken.
        self.least, self.most, self.top = least.copy(), most, top
        self.open = least <= most
        self.held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def floor(self, anchors: np.ndarray) -> np.ndarray:
        """The lowest score that may still count in any window of each anchor. Windows without any score in them need nothing."""
        return np.where(self.open[anchors], self.least[anchors].astype(float), np.inf).min(1)

    def offer(self, anchors: np.ndarray, score: np.ndarray, allowed: np.ndarray, vec_id: np.ndarray, row: np.ndarray) -> None:
        for w in range(self.least.shape[1]):
            hit = allowed & (score >= self.least[anchors, w, None]) & (score <= self.most[anchors, w, None])
            for a in np.flatnonzero(hit.any(1)):
                at, key = np.flatnonzero(hit[a]), (int(anchors[a]), w)
                if len(at) > 4 * self.top:
                    # Everything at least as good as the top-th best stays, ties included.
                    own = score[a, at]
                    at = at[own >= np.partition(own, len(own) - self.top)[len(own) - self.top]]
                s, i, r = score[a, at], vec_id[at], row[at]
                if key in self.held:
                    s, i, r = (np.concatenate(x) for x in zip(self.held[key], (s, i, r)))
                order = np.lexsort((r, i, -s))[: self.top]
                self.held[key] = s[order], i[order], r[order]
                if len(order) == self.top:
                    self.least[key] = max(self.least[key], s[order[-1]])


def _walk(anchors: Anchors, best: Best, same: bool, row: np.ndarray, vec_id: np.ndarray, label: np.ndarray, rows: np.ndarray) -> None:
    """All anchors over one set of candidates: those of the same label and another row, or those of another label."""
    length = np.linalg.norm(rows, axis=1)
    unit = rows / np.maximum(length, 1e-300)[:, None]
    cosine = np.clip(unit @ anchors.centres.T, -1, 1)
    for c in range(len(anchors.centres)):
        members = np.arange(anchors.begins[c], anchors.begins[c + 1])
        # No anchor of the cluster is nearer to a candidate than the angle to the centre less the widest of the cluster; a little more for floats.
        angle = np.maximum(np.arccos(cosine[:, c]) - anchors.widest[c] - 1e-6, 0.0)
        bound = length * np.cos(angle) * np.where(np.cos(angle) > 0, 1 + 1e-9, 1 - 1e-9) + 1e-6
        order = np.argsort(-bound, kind="stable")
        for begin in range(0, len(order), STEP):
            # Nothing further down the list can be better than this for a member.
            reach = bound[order[begin]] * anchors.length[members]
            members = members[reach + 1e-6 + np.abs(reach) * 1e-9 >= best.floor(members)]
            if not len(members):
                break
            at = order[begin : begin + STEP]
            score = V.products(anchors.vectors[members], rows[at])
            alike = anchors.label[members][:, None] == label[at][None, :]
            allowed = alike & (anchors.row[members][:, None] != row[at][None, :]) if same else ~alike
            best.offer(members, score, allowed, vec_id[at], row[at])


def _task(sent, same: bool, top: int):
    """What a task's candidates have to offer each anchor and window; thresholds hold on from list to list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, least, most = sent.value
        best = Best(least, most, top)
        held, size = [], 0

        def walk():
            row, vec_id, label = (np.concatenate([h[c] for h in held]) for c in range(3))
            _walk(anchors, best, same, row, vec_id, label, np.concatenate([h[3] for h in held]))
            held.clear()

        for batch in batches:
            if not len(batch):
                continue
            vec_id = batch.column("vec_id").fill_null(_LAST).to_numpy()
            rows = V.matrix(batch.column("vector").to_pylist(), anchors.vectors.shape[1])
            held.append((batch.column("row").to_numpy(), vec_id, batch.column("label").to_numpy(), rows))
            size += len(batch)
            if size >= LIST:
                walk()
                size = 0
        if held:
            walk()
        if best.held:
            size = [len(score) for score, _, _ in best.held.values()]
            score, vec_id, row = (np.concatenate(x) for x in zip(*best.held.values()))
            anchor, window = (np.repeat(x, size) for x in np.array(list(best.held)).T)
            ids = pa.array(vec_id, pa.int64(), mask=vec_id == _LAST)
            columns = [pa.array(anchors.row[anchor]), pa.array(window.astype(np.int32)), pa.array(score), ids, pa.array(row)]
            yield pa.record_batch(columns, names=["anchor", "window", "score", "vec_id", "row"])

    return run


_OFFER = "anchor long, window int, score long, vec_id long, row long"


def _prepared(factor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, found = V.scaled(batch.column("vector"), factor, LARGEST)
            rows = pa.array(places, pa.int64())
            yield pa.record_batch(
                [batch.column(c).take(rows) for c in ("vec_id", "label")] + [pa.array([V.packed(v) for v in found], pa.binary())],
                names=["vec_id", "label", "vector"],
            )

    return run


def _top(offers: DataFrame, top: int) -> DataFrame:
    """The best of what all tasks offer, numbered from 1. Spark keeps the first ``top`` of a window before the shuffle, too."""
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return offers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def hard_negatives(
    embeddings: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    factor: int = 256,
    relabel=None,
) -> DataFrame:
    """Per anchor and positive the best negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows of ``embeddings`` (vec_id, label, embedding) take part if label and vector are not null and all components are finite; components
    count as integers floor(``factor`` * x), and vectors of 2^31 or more in length are left out, as their products fit no long. ``relabel`` changes the
    label column first. Anchors are the rows whose vec_id is divisible by ``every``. The score of a row is its exact
    inner product with the anchor (of unequal sizes, over the common components); of equal scores the smaller vec_id comes first, null last. Positives are the
    anchor's first ``positives`` other rows of its label. Of the rows of other labels with
    ``low`` * positive score <= 100 * score <= ``high`` * positive score, the first ``negatives`` are returned. A positive without any gives no
    row. Repeated rows count each, also as anchors. Further columns are left out; an empty table gives an empty one.

    Anchors are taken in blocks of a fixed size that are broadcast one after another, clustered by angle. A task gathers candidates
    to lists, sorts a list once per cluster by an upper bound on the score with any of its anchors, and all anchors of the cluster walk it, in steps of exact
    products, each until the bound falls below the last place of its results. No bound is approximate, so nothing is missed. Tasks' results meet by
    anchor, at most ``negatives`` per task, anchor and positive; neither candidates nor a label's rows are ever shuffled or gathered.
    """
    spark = embeddings.sparkSession
    label = (relabel(F.col("vec_id"), F.col("label").cast("long")) if relabel else F.col("label")).cast("long")
    source = V.checked(embeddings, "vec_id", "label", "embedding")
    source = source.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), V.as_doubles("embedding").alias("vector")).where("label is not null")
    # Written once: rows get a number that stays.
    kept = source.mapInArrow(_prepared(factor), "vec_id long, label long, vector binary")
    rows = saved(kept.withColumn("row", F.monotonically_increasing_id()))
    asking = rows.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-asking.count() // BLOCK))
    asking = saved(asking.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")), by="block") if blocks > 1 else asking.withColumn("block", F.lit(0))
    folder = new_folder(spark)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    saved(spark.createDataFrame([], schema), path=f"{folder}/block=-1")
    for b in range(blocks):
        own = asking.where(F.col("block") == b).orderBy("row").select("row", "vec_id", "label", "vector").collect()
        if own:
            width = max(len(r["vector"]) for r in own) // 4
            vectors = V.matrix([bytes(r["vector"]) for r in own], width)
            anchors = Anchors.of(np.array([r["row"] for r in own]), np.array([r["label"] for r in own]), vectors)
            _block(rows, anchors, {r["row"]: r["vec_id"] for r in own}, positives, negatives, low, high, f"{folder}/block={b}")
    return spark.read.schema(schema + ", block int").parquet(folder).drop("block")


def _block(rows: DataFrame, anchors: Anchors, ids: dict[int, int], positives: int, negatives: int, low: int, high: int, path: str) -> None:
    """Writes the results of one block of anchors. The driver holds the block and its positives; executors let go of them in the end."""
    spark, n = rows.sparkSession, len(anchors.row)
    sent = spark.sparkContext.broadcast((anchors, np.full((n, 1), -(1 << 62)), np.full((n, 1), 1 << 62)))
    first = _top(rows.mapInArrow(_task(sent, True, positives), _OFFER), positives).collect()
    sent.unpersist()
    place = {int(r): i for i, r in enumerate(anchors.row)}
    least, most = np.ones((n, positives), np.int64), np.zeros((n, positives), np.int64)
    for r in first:
        at = place[r["anchor"]], r["rank"] - 1
        least[at], most[at] = -(-low * r["score"] // 100), high * r["score"] // 100
    known = spark.createDataFrame(
        [(r["anchor"], r["rank"] - 1, ids[r["anchor"]], r["vec_id"], r["score"]) for r in first],
        "anchor long, window int, anchor_id long, positive_id long, positive_score long",
    )
    sent = spark.sparkContext.broadcast((anchors, least, most))
    found = _top(rows.mapInArrow(_task(sent, False, negatives), _OFFER), negatives)
    named = found.join(known, ["anchor", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
    saved(named, path=path)
    sent.unpersist()
