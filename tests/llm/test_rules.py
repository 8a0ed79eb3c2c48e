"""Quality rules: the threshold, its verdicts on labels it has not seen, and filters on results of all operators."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from dealerlake.llm import quality_rules as Q
from dealerlake.llm.near_duplicates import keep_one
from dealerlake.llm.mixing import mix, mixed_rows, targets
from dealerlake.llm.queries import QUERIES, one_two_three
from dealerlake.llm.store import importable
from tests.llm import brute

FOLDER = "/root/testdata/sf0.01"


def threshold(spark, good, bad):
    rows = [(i, float(r), q) for i, (r, q) in enumerate([(r, 1) for r in good] + [(r, 0) for r in bad])]
    # Ids whose remainder is not 1, so that all count.
    ids = [i for i in range(10 * len(rows) + 10) if brute.fold(i, 3) != 1]
    ratios = spark.createDataFrame([(ids[i], r) for i, r, _ in rows], "doc_id long, ratio double")
    return Q.best_threshold(ratios, spark.createDataFrame([(ids[i], q) for i, _, q in rows], "doc_id long, quality int"))


def test_threshold(spark):
    good = np.linspace(0, 0.2, 400)
    assert -0.55 < threshold(spark, good, [-1, -1.5, -3]) < -0.4  # the middle of the gap
    assert -0.55 < threshold(spark, [*good, -2], [-1, -1.5, -3]) < -0.4  # one good document among the bad is lost
    # Bad documents amid the good ones cost no more than one in two hundred of those.
    assert np.mean(good < threshold(spark, good, [0.1, 0.15])) <= 0.005
    assert threshold(spark, good, [0.3]) == Q.THRESHOLD  # nothing is gained by any cut
    assert threshold(spark, good, []) == threshold(spark, [], [1]) == Q.THRESHOLD


def test_log_ratios_by_brute_force(spark):
    texts = {1: "b a b a", 2: "a c", 3: "", 4: "words like these words", 5: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (4, 0), (3, 1), (9, 1)], "doc_id long, quality int")
    found = Q.log_ratios(docs, labels)
    count = lambda ids: np.bincount([b for i in ids for b in buckets(spark, brute.WORD.findall(texts[i] or ""))], minlength=Q.BUCKETS)
    raw, target = count(texts), count([1, 3])
    expected = np.log((target + 1) / (target.sum() + Q.BUCKETS)) - np.log((raw + 1) / (raw.sum() + Q.BUCKETS))
    assert np.abs(np.array(found) - expected).max() <= 5.1e-5 and raw.sum() == 3 * 10


def buckets(spark, words):
    """The three n-grams of each word: itself, itself with the next, its ending."""
    if not words:
        return []
    df = spark.createDataFrame([(w, w[-3:]) for w in words], "w string, e string")
    hashed = [(r[0], r[1]) for r in df.select(F.xxhash64("w"), F.xxhash64("e")).collect()]
    low = lambda x, bits: (x >> bits) % Q.BUCKETS
    after = [h for h, _ in hashed[1:]] + [0]
    return [x for (h, e), n in zip(hashed, after) for x in (low(h, 0), low(signed(h << 1) ^ n, 14), low(e, 28))]


def signed(x):
    return (x + (1 << 63)) % (1 << 64) - (1 << 63)


def test_verdicts_on_labels_that_were_not_seen(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    of = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    seen = labels.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) != 1)
    out = [r for r in Q.quality_rules(docs, seen).collect() if r.doc_id in of and brute.fold(r.doc_id, 3) == 1 and not r.base_failed]
    assert np.mean([r.kept for r in out if of[r.doc_id] == 1]) >= 0.99
    assert np.mean([r.kept for r in out if of[r.doc_id] == 0]) <= 0.05


@pytest.mark.parametrize("query", QUERIES, ids=lambda q: q.__name__)
def test_a_filter_on_a_result_costs_no_more_than_the_result(spark, query):
    """Each query filtered on its last columns, which must not take minutes on the smallest tables."""
    start = time.time()
    out = importable(query)(spark, "/root/testdata/sf0.001")
    every = out.count()
    for column in out.columns[-2:]:
        kept = out.where(F.col(column).isNotNull() & (F.col(column).cast("string") != "none such"))
        assert kept.select(out.columns[0]).count() <= every
    assert time.time() - start < 300


def test_targets_of_sources_that_weigh_nothing():
    assert targets({"a": 10, "b": 100}, {"a": 1, "b": 0}, 110) == {"a": 30.0, "b": 0.0}
    assert targets({"a": 10}, {"a": 0}, 10) == {"a": 0.0}


def test_mix_with_long_documents_and_sources_without_weight(spark):
    """Each source has a document of half its words, which the order meets anywhere; short ones make up for it."""
    rows = []
    for s in range(12):
        rows += [(1000 * s, "w " * 6000, f"s{s:02d}")] + [(1000 * s + i, "w " * (20 + i % 90), f"s{s:02d}") for i in range(1, 95)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sources = docs.withColumn("sources", F.array("source"))
    for seed in range(2):
        weigh = lambda names: {n: float(i % 3) for i, n in enumerate(names)}
        chosen, sizes, goal = mix(sources, weigh, seed=seed)
        taken = {r.sources[0]: r.taken for r in chosen.groupBy("sources").agg(F.sum("taken").alias("taken")).collect()}
        assert all(abs(taken[s] - goal[s]) < 1.01 for s in goal) and goal["s00"] == 0
        assert chosen.where("taken > 3 * size OR taken < 0").count() == 0
        whole = {}
        for r in mixed_rows(docs, weigh, seed=seed).collect():
            whole[r.source] = whole.get(r.source, 0) + len(r.text) // 2
        assert all(abs(whole.get(s, 0) - goal[s]) <= 0.01 * goal[s] for s in goal)


def test_rows_that_share_an_id_are_mixed_each(spark):
    rows = [(1, "w " * 10, "a", "x"), (1, "w " * 30, "a", "y"), (2, "w " * 20, "b", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, note string").withColumn("tag", F.lit("own")).withColumn("row", F.lit(1))
    out = mixed_rows(docs, one_two_three).collect()
    assert sum(len(r.text) // 2 for r in out if r.source == "a") == 20 or sum(len(r.text) // 2 for r in out) <= 65
    assert all((r.doc_id, r.text, r.source, r.note) in rows and r.tag == "own" for r in out)


def test_rows_that_share_an_id_are_told_apart_by_their_text(spark):
    one, two, three = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, one), (1, two), (1, one), (2, two), (3, three), (4, three + " more"), (4, one), (None, one), (None, one)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("own"))
    kept = sorted(((r.doc_id or 0, r.text) for r in keep_one(docs).collect()))
    assert len(kept) == 5 and {t for i, t in kept if i} == {one, two, three}
    # A document with an id of its own stays rather than one of a repeated id.
    assert (2, two) in kept and (3, three) in kept and kept.count((0, one)) == 2
