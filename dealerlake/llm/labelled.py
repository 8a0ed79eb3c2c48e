"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(doc_id, text, label as a double) of at most ``rows`` labelled documents, drawn by a hash of the id.

    Several labels of one document are averaged; null labels and ids don't count. The sample has at most
    ``rows`` ids, so it is broadcast, and the texts of other documents are dropped where they are read. Of rows that repeat an id the smallest
    text stands for it, so there are no more rows than ids.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg(F.col(label).cast("double")).alias("label"))
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(drawn), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
