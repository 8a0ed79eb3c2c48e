"""Near-duplicate documents by a multi-index Hamming join of b-bit MinHash signatures, confirmed on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealerlake.llm import words as W
from dealerlake.llm.graph import components
from dealerlake.llm.store import saved

#: Positions of a signature, and bits kept of each.
POSITIONS = 64
BITS = 16
#: Differing positions allowed in a chunk, and the odds of missing a pair right at the threshold. By the
#: pigeonhole principle two signatures that differ in fewer than chunks * (ERRORS + 1) positions agree in one
#: chunk but for at most ERRORS positions; ``chunks`` gives the number of chunks that these odds take.
ERRORS = 1
ODDS = 2e-5
#: Members of one bucket that are compared in one block; larger buckets become several blocks.
BLOCK = 512

_MULTIPLY = W.mix(np.arange(1, POSITIONS + 1, dtype=np.uint64)) | np.uint64(1)
_ADD = W.mix(np.arange(1001, POSITIONS + 1001, dtype=np.uint64))


def chunks(percent: int) -> int:
    """Chunks a signature is cut into: 12 for a similarity of 85 percent, 14 for 80."""
    differ = 1 - percent / 100
    tail = lambda least: sum(comb(POSITIONS, i) * differ**i * (1 - differ) ** (POSITIONS - i) for i in range(least, POSITIONS + 1))
    count = 1
    while count < POSITIONS // (ERRORS + 1) and tail(count * (ERRORS + 1)) > ODDS:
        count += 1
    return count


def _signatures(shingle: np.ndarray, total: np.ndarray) -> np.ndarray:
    """One row of POSITIONS 16-bit numbers per text that has shingles."""
    begins = total[:-1][np.diff(total) > 0]
    out = np.empty((len(begins), POSITIONS), np.uint16)
    if len(begins):
        for i in range(POSITIONS):
            least = np.minimum.reduceat(shingle * _MULTIPLY[i] + _ADD[i], begins)
            out[:, i] = W.mix(least) >> np.uint64(64 - BITS)
    return out


def _sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(number of the first text, signatures, shingles, where each text's begin) per slice."""
    for first, data, offsets in W.slices(column):
        word, begins = W.words(data, offsets, lower=True)
        shingle, total = W.shingles(word, begins, size)
        yield first, _signatures(shingle, total), shingle, total


def _parity(unique: np.ndarray) -> bytes:
    """Bit i is the parity of how many shingles fall on i; at least two bits a shingle, a power of two.

    Where two sets' bits differ, a shingle is in one of them only. So the differing bits are a lower
    bound of the symmetric difference, and give an upper bound of the similarity.
    """
    size = max(64, 1 << (2 * len(unique) - 1).bit_length())
    counts = np.bincount((unique & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def _profiles(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, key1, key2, signature = [], [], [], []
            with np.errstate(over="ignore"):
                for _, rows, shingle, total in _sets(batch.column("text"), size):
                    row = 0
                    for a, b in zip(total[:-1], total[1:]):
                        if a == b:
                            n.append(0), key1.append(0), key2.append(0), signature.append(None)
                            continue
                        unique = np.unique(shingle[a:b])
                        n.append(len(unique))
                        key1.append(int(unique.sum().view(np.int64)))
                        key2.append(int(W.mix(unique).sum().view(np.int64)))
                        signature.append(rows[row].tobytes())
                        row += 1
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(key1, pa.int64()), pa.array(key2, pa.int64()), pa.array(signature, pa.binary())],
                names=["doc_id", "n_shingles", "key1", "key2", "signature"],
            )

    return run


def _chunk_keys(count: int):
    """Keys of each of ``count`` chunks with every choice of ERRORS positions left out (written out for one)."""
    edges = [POSITIONS * i // count for i in range(count + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([np.frombuffer(x, np.uint16) for x in batch.column("signature").to_pylist()], np.uint64).reshape(-1, POSITIONS)
            node = batch.column("node").to_numpy(zero_copy_only=False)
            keys = []
            with np.errstate(over="ignore"):
                for a, b in zip(edges[:-1], edges[1:]):
                    for out in range(a, b):
                        key = np.full(len(rows), out, np.uint64)
                        for position in range(a, b):
                            if position != out:
                                key = W.mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, position])
                        keys.append(key)
            key = np.concatenate(keys).view(np.int64)
            yield pa.record_batch([pa.array(key), pa.array(np.tile(node, len(keys)))], names=["key", "node"])

    return run


def _turn(node: str, key: str):
    """The node under a mask that the key gives, so that the smallest one is another node in each bucket; undoes itself."""
    return F.col(node).bitwiseXOR(F.xxhash64(key))


def _set_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, parity, members = [], [], []
            for first, data, offsets in W.slices(batch.column("text")):
                with np.errstate(over="ignore"):
                    shingle, total = W.shingles(*W.words(data, offsets, lower=True), size)
                for a, b in zip(total[:-1], total[1:]):
                    unique = np.unique(shingle[a:b])
                    n.append(len(unique)), parity.append(_parity(unique) if len(unique) else b""), members.append(unique.tobytes())
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(parity, pa.binary()), pa.array(members, pa.large_binary()).cast(pa.binary())],
                names=["node", "n", "parity", "members"],
            )

    return run


def _fold(bits: np.ndarray, width: int) -> np.ndarray:
    """Parity rows over fewer bits."""
    while bits.shape[1] > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def _may_link(n1, n2, differing, percent: int):
    """100 * intersection >= percent * union can hold, if at least ``differing`` shingles are in one set only."""
    return 100 * (n1 + n2 - differing) >= percent * (n1 + n2 + differing)


def _bounded_pairs(percent: int):
    """Rows (x, y, n1, parity1, n2, parity2) that the bound lets through, as (x, y)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, n1, p1, n2, p2 = (c.to_pylist() for c in batch.columns)
            keep = []
            for i in range(len(x)):
                if not _may_link(n1[i], n2[i], abs(n1[i] - n2[i]), percent):
                    continue
                a, b = (np.frombuffer(p, np.uint64)[None] for p in (p1[i], p2[i]))
                width = min(a.shape[1], b.shape[1])
                if _may_link(n1[i], n2[i], int(np.bitwise_count(_fold(a, width) ^ _fold(b, width)).sum()), percent):
                    keep.append(i)
            yield pa.record_batch([batch.column(0).take(pa.array(keep, pa.int64())), batch.column(1).take(pa.array(keep, pa.int64()))], names=["x", "y"])

    return run


def _confirmed(percent: int):
    """Rows (x, y, members1, members2) that are links by their full sets, as (x, y)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(len(batch)):
                a, b = (np.frombuffer(batch.column(c)[i].as_py(), np.uint64) for c in (2, 3))
                common = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * common >= percent * (len(a) + len(b) - common):
                    keep.append(i)
            keep = pa.array(keep, pa.int64())
            yield pa.record_batch([batch.column(0).take(keep), batch.column(1).take(keep)], names=["x", "y"])

    return run


def _block_pairs(percent: int):
    """Pairs of different components within each run of rows of one (key, low, high), through the bound.

    Rows come sorted by those three. A block pair has some BLOCK rows of either side.
    """

    def pairs(rows: list[tuple]) -> tuple[list[int], list[int]]:
        low, high = rows[0][1], rows[0][2]
        left = [r for r in rows if r[3] == low]
        right = left if low == high else [r for r in rows if r[3] == high]
        xs, ys = [], []
        by_width: dict[int, list[tuple]] = {}
        for r in right:
            by_width.setdefault(len(r[7]) // 8, []).append(r)
        sides = {
            width: (
                np.array([r[4] for r in group]),
                np.array([r[5] for r in group]),
                np.array([r[6] for r in group], np.int64),
                np.array([np.frombuffer(r[7], np.uint64) for r in group]),
            )
            for width, group in by_width.items()
        }
        for r in left:
            own = np.frombuffer(r[7], np.uint64)[None]
            for width, (node, component, n, bits) in sides.items():
                at = np.flatnonzero((component != r[5]) & ((node > r[4]) | (low != high)) & _may_link(n, r[6], np.abs(n - r[6]), percent))
                if len(at):
                    least = min(width, own.shape[1])
                    differing = np.bitwise_count(_fold(bits[at], least) ^ _fold(own, least)).sum(axis=1).astype(np.int64)
                    at = at[_may_link(n[at], r[6], differing, percent)]
                    xs += [r[4]] * len(at)
                    ys += node[at].tolist()
        return xs, ys

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def done():
            xs, ys = pairs(held)
            return pa.record_batch([pa.array(xs, pa.int64()), pa.array(ys, pa.int64())], names=["x", "y"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][:3] != row[:3]:
                    yield done()
                    held = []
                held.append(row)
        if held:
            yield done()

    return run


def _with_both(pairs: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    one = sets.select(F.col("node").alias("x"), *[F.col(c).alias(f"{c}1") for c in columns])
    two = sets.select(F.col("node").alias("y"), *[F.col(c).alias(f"{c}2") for c in columns])
    return pairs.join(one, "x").join(two, "y").select("x", "y", *[f"{c}1" for c in columns], *[f"{c}2" for c in columns])


def near_duplicates(docs: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    A document's set is its distinct runs of ``size`` words, A-Z lower-cased; with fewer words, the
    whole sequence. Documents are linked when 100 * intersection >= ``percent`` * union, and
    component_id is the smallest doc_id that links reach; ``kept`` marks that document.

    Method: equal sets collapse into a class, whose node is its smallest doc_id. Signatures of classes
    are cut into chunks, and each chunk gives a key for every choice of positions that may differ.
    Nodes that share a key are compared: first each with one node of the bucket, which joins most of
    a large group of copies; then, in buckets that still hold several components, all pairs across
    components, in blocks. Only pairs that pass an exact upper bound are kept, and all of those
    are confirmed on the full sets. So within a bucket no link between components is lost, and no
    group of copies is expanded into all its pairs.

    Null, empty and blank texts have an empty set and are linked with nothing. Rows with a null id are
    linked with nothing, have a null component and are kept. Rows that repeat an id go each by its
    own text. An empty table gives an empty one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    profiles = saved(docs.mapInArrow(_profiles(size), "doc_id long, n_shingles long, key1 long, key2 long, signature binary"))
    linkable = profiles.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = saved(linkable.groupBy("key1", "key2").agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature")))

    keys = classes.select("node", "signature").mapInArrow(_chunk_keys(chunks(percent)), "key long, node long")
    turned = keys.withColumn("turned", _turn("node", "key"))
    shared = turned.groupBy("key").agg(F.min("turned").alias("first"), F.max("turned").alias("last"), F.count("*").alias("members"))
    shared = shared.where(F.col("first") != F.col("last")).drop("last")
    buckets = saved(keys.join(shared, "key").select("key", "node", "members", _turn("first", "key").alias("leader")))

    involved = buckets.select(F.col("node").alias("doc_id")).distinct()
    sets = saved(docs.join(involved, "doc_id", "left_semi").mapInArrow(_set_rows(size), "node long, n long, parity binary, members binary").where("n > 0"))

    def confirm(pairs: DataFrame) -> DataFrame:
        return saved(_with_both(pairs, sets, "members").mapInArrow(_confirmed(percent), "x long, y long"))

    stars = buckets.where("node <> leader").select(F.least("node", "leader").alias("x"), F.greatest("node", "leader").alias("y")).distinct()
    near = _with_both(stars, sets, "n", "parity").mapInArrow(_bounded_pairs(percent), "x long, y long")
    links = confirm(near)

    placed = buckets.join(components(links, "x", "y"), "node", "left").select("key", "node", "members", F.coalesce("component", "node").alias("component"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least <> most").select("key")
    blocks = F.ceil(F.col("members") / BLOCK)
    rows = (
        placed.join(mixed, "key")
        .withColumn("block", F.pmod(F.xxhash64("node"), blocks))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks.cast("long") - 1)))
        .select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "component")
        .join(sets.select("node", "n", "parity"), "node")
        .select("key", "low", "high", "block", "node", "component", "n", "parity")
    )
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    across = (
        rows.repartition(partitions, "key", "low", "high")
        .sortWithinPartitions("key", "low", "high")
        .mapInArrow(_block_pairs(percent), "x long, y long")
        .select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        .distinct()
    )
    found = saved(components(links.union(confirm(across)), "x", "y"))

    labels = classes.select("key1", "key2", "node").join(found, "node", "left").select("key1", "key2", F.coalesce("component", "node").alias("label"))
    linked = linkable.select("doc_id", "n_shingles", "key1", "key2").join(labels, ["key1", "key2"]).select("doc_id", "n_shingles", "label")
    alone = profiles.where("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("label"))
    return linked.union(alone).select(
        "doc_id", "n_shingles", F.col("label").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("label"), F.lit(True)).alias("kept")
    )


def keep_one(docs: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, all columns as they are.

    Rows that repeat an id with another text are documents of their own: each goes only where its text is a near
    duplicate, and then a document with an id of its own stays rather than one of them. Rows without an id all stay.
    """
    doc_id = F.col("row.doc_id").cast("long")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.xxhash64("row.text")
    known = rows.where(doc_id.isNotNull()).groupBy(doc_id.alias("id")).agg(F.min(text).alias("low"), F.max(text).alias("high"))
    # Written, so that Spark knows its size when it picks the join.
    repeated = saved(known.where("low <> high").select("id"))
    # Beyond all usual ids, so that those come first.
    own = F.xxhash64(doc_id, "row.text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    rows = rows.join(repeated, doc_id == F.col("id"), "left").select("row", F.when(F.col("id").isNotNull(), own).otherwise(doc_id).alias("node"))
    found = near_duplicates(rows.where("node IS NOT NULL").select(F.col("node").alias("doc_id"), "row.text"), percent, size)
    kept = found.where("kept").select(F.col("doc_id").alias("node")).distinct()
    stay = rows.join(kept, "node", "left_semi").dropDuplicates(["node"])
    return stay.select("row").union(rows.where("node IS NULL").select("row")).select("row.*")
