"""Exact token counts by a two-tier look-up: a broadcast table of frequent pieces, then a cache in each worker."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealerlake.llm import words as W
from dealerlake.llm.pieces import encode, slices, worker_cache

#: Pieces in the broadcast table, and pieces that one task proposes for it. Both are fixed, so neither
#: the table nor what is sent for it outgrows its bound; results don't depend on them.
FREQUENT = 65_536
PROPOSED = 16_384


def _proposals(path: str):
    """The most frequent pieces of a task, with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, count, text = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, object)
        for batch in batches:
            for _, found, _, text_of, _ in slices(path, batch.column("text")):
                if not len(found):
                    continue
                unique, at, n = np.unique(found, return_index=True, return_counts=True)
                # Only what occurs often in a slice is worth its text; the others join by count if they do later.
                often = np.argsort(-n, kind="stable")[:PROPOSED]
                piece, count = np.concatenate([piece, unique[often]]), np.concatenate([count, n[often]])
                text = np.concatenate([text, np.array([text_of(i) for i in at[often]], object)])
                piece, at, inverse = np.unique(piece, return_index=True, return_inverse=True)
                count, text = np.bincount(inverse, count).astype(np.int64), text[at]
                if len(piece) > 8 * PROPOSED:
                    keep = np.sort(np.argsort(-count, kind="stable")[: 4 * PROPOSED])
                    piece, count, text = piece[keep], count[keep], text[keep]
        keep = np.argsort(-count, kind="stable")[:PROPOSED]
        yield pa.record_batch([pa.array(piece[keep].view(np.int64)), pa.array(text[keep].tolist(), pa.string()), pa.array(count[keep])], names=["piece", "text", "count"])

    return run


def _counted(path: str, table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, lengths = table.value
        for batch in batches:
            out = []
            for _, piece, begins, text_of, whole in slices(path, batch.column("text")):
                size = np.zeros(len(piece), np.int64)
                if len(piece):
                    spot = np.minimum(np.searchsorted(frequent, piece), max(len(frequent) - 1, 0))
                    hit = frequent[spot] == piece if len(frequent) else np.zeros(len(piece), bool)
                    size[hit] = lengths[spot[hit]]
                    miss = np.flatnonzero(~hit)
                    if len(miss):
                        cached = worker_cache(path)
                        entry = cached.find(piece[miss], lambda i: text_of(miss[i]))
                        size[miss] = cached.size[entry]
                total = np.concatenate([[0], np.cumsum(size)])
                count = total[begins[1:]] - total[begins[:-1]]
                for i, ids in whole.items():
                    count[i] = len(ids)
                out.append(count)
            yield pa.record_batch([batch.column("doc_id"), batch.column("n_bytes"), pa.array(np.concatenate(out) if out else np.zeros(0, np.int64))], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_tokens, over_limit.

    ``n_tokens`` is what the tokenizers library gives for the whole text, without added tokens. A
    first pass counts pieces in every task and sends the task's most frequent ones; the most
    frequent of all are encoded once and broadcast as a sorted array of hashes with their lengths.
    The second pass looks pieces up there, then in the worker's cache, and encodes what neither has.
    Pieces are never shuffled: only each task's bounded proposals are.

    Null texts are empty: no bytes, no tokens. An empty table gives an empty one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    proposed = docs.select("text").mapInArrow(_proposals(tokenizer), "piece long, text string, count long")
    top = (
        proposed.groupBy("piece").agg(F.sum("count").alias("count"), F.min(F.col("text")).alias("text"))
        .orderBy(F.desc("count"), "piece").limit(FREQUENT).select("piece", "text").toPandas()
    )
    frequent = top["piece"].to_numpy(np.int64).view(np.uint64) if len(top) else np.zeros(0, np.uint64)
    lengths = np.array([len(x) for x in encode(tokenizer, top["text"].tolist())], np.int32)
    order = np.argsort(frequent)
    table = docs.sparkSession.sparkContext.broadcast((frequent[order], lengths[order] if len(order) else lengths))
    return (
        docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
        .mapInArrow(_counted(tokenizer, table), "doc_id long, n_bytes long, n_tokens long")
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
