"""The training-data pipeline over ``documents``: each stage works on all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's ``docs``. All but the last return the columns of ``documents``. Nulls, empty texts,
repeated rows, empty tables and further columns are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dealerlake.llm.mixing import mixed_rows
from dealerlake.llm.near_duplicates import keep_one
from dealerlake.llm.packing import pack
from dealerlake.llm.quality_model import keep_good
from dealerlake.llm.quality_rules import keep_by_rules
from dealerlake.llm.queries import one_two_three, piece_digests, tokenizer_file
from dealerlake.llm.store import importable, read, saved


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the additive model scores 0.5 or more."""
    return keep_good(docs, read(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of 50 words or more that don't repeat themselves and don't look unlike the trusted ones."""
    return keep_by_rules(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: sources weigh 1, 2, 3 in turn, at most three copies, as many words in all."""
    return mixed_rows(docs, weights=one_two_three)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2,048 ids, sources in the proportions of the whole."""
    return piece_digests(pack(docs, tokenizer_file("byte_bpe_50k.json")))


STAGES = [
    ("quality_classifier", importable(quality_classifier)),
    ("quality_rules", importable(quality_rules)),
    ("near_dedup", importable(near_dedup)),
    ("mixing", importable(mixing)),
    ("packing", importable(packing)),
]

#: Learned scores, signatures and token ids can't be expressed in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
