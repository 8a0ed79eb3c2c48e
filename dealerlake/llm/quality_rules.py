"""Quality rules: length, repetition, and a likelihood ratio of hashed n-grams between a trusted target and the raw corpus."""

from __future__ import annotations

from contextlib import ExitStack

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealerlake.llm.native import has_word, head, word_array
from dealerlake.llm.store import remainder, saved
from dealerlake.session import setting

#: Buckets n-grams are hashed into.
BUCKETS = 16_384
#: Characters at the end of a word that stand for it in n-grams of their own, beside those of whole words. Endings are few, so they are known
#: even where most words are new.
ENDING = 3
#: Without labelled documents of both kinds, a document stays if its mean log ratio, in nats per n-gram, is no lower than this.
THRESHOLD = -0.5
#: Ratios are told apart by this much where the threshold is sought, and so many of the good documents may lie below it.
STEP = 0.01
LOST = 0.005


#: Bits by which hashes are moved before they give a bucket, so that the same words in n-grams of another kind fall into others.
_BITS = 14


def _ending(word: Column) -> Column:
    return F.substring(word, -ENDING, ENDING)


def _bucket(kind: int, hashed: Column) -> Column:
    return F.shiftright(hashed, _BITS * kind).bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def _pair(first: Column, second: Column) -> Column:
    """A hash of two neighbours from their hashes; nothing follows the last."""
    return F.shiftleft(first, 1).bitwiseXOR(F.coalesce(second, F.lit(0)))


def _grams(docs: DataFrame) -> DataFrame:
    """``docs`` with ``w`` (words) gains ``h``, their hashes, and ``grams``: the buckets of words, of words with the next one, and of their endings."""
    hashed = docs.withColumns({"h": F.transform("w", lambda x: F.xxhash64(x)), "e": F.transform("w", lambda x: F.xxhash64(_ending(x)))})
    words = F.transform("h", lambda x: _bucket(0, x))
    pairs = F.transform("h", lambda x, i: _bucket(1, _pair(x, F.get("h", i + 1))))
    endings = F.transform("e", lambda x: _bucket(2, x))
    return hashed.withColumn("grams", F.concat(words, pairs, endings)).drop("e")


def _counts(docs: DataFrame) -> np.ndarray:
    """How often the n-grams of texts fall into each bucket."""
    # A row per word, as hashes are compiled there and not within functions over arrays. The outer kind, as the other lets Spark test the array
    # first, and so compute it once more for each element.
    split = docs.select(word_array(F.col("text")).alias("w"))
    after = F.slice("w", F.lit(2), F.greatest(F.size("w") - 1, F.lit(0)))
    rows = split.select(F.explode_outer(F.arrays_zip(F.col("w"), after.alias("after"))).alias("z")).where("z.w IS NOT NULL")
    following = F.when(F.col("z.after").isNotNull(), F.xxhash64("z.after"))
    rows = rows.select(F.xxhash64("z.w").alias("h"), following.alias("next"), F.xxhash64(_ending(F.col("z.w"))).alias("e"))
    grams = F.array(_bucket(0, F.col("h")), _bucket(1, _pair(F.col("h"), F.col("next"))), _bucket(2, F.col("e")))
    found = rows.select(F.explode(grams).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))
    out = np.zeros(BUCKETS)
    for r in found.collect():
        out[r["bucket"]] = r["n"]
    return out


#: Lets Spark drop most rows that can't meet a join's other side where they are read, by a Bloom filter of bounded size. No side is broadcast whole: trusted ids
#: grow with the corpus, and the plan should not change where they pass a size.
_FILTER_EARLY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
}


def log_ratios(docs: DataFrame, labels: DataFrame) -> list[float]:
    """Per bucket the log of its share in the trusted target over its share in the raw corpus, to four digits.

    Shares are counts plus one. The raw corpus is all of ``docs`` (doc_id, text); the target are all those with
    ``labels.quality`` = 1. Only texts of the target are shuffled, to meet their labels: trusted ids grow with the corpus, so that join is
    by shuffle at every size.
    """
    ids = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"))
    raw = _counts(docs)
    with ExitStack() as settings:
        for key, value in _FILTER_EARLY.items():
            settings.enter_context(setting(docs.sparkSession, key, value))
        target = _counts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id", "left_semi"))
    if not target.any():
        return [0.0] * BUCKETS  # nothing to compare with
    ratios = np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))
    return ratios.round(4).tolist()


def best_threshold(ratios: DataFrame, labels: DataFrame) -> float:
    """The ratio that best parts labelled documents of (doc_id, ratio): the share of good ones at or above it plus that of bad ones below.

    Of those only that leave LOST of the good documents below, so that few or unusual bad ones never cost many good ones; in the middle of the widest
    stretch of equally good ones. All labelled documents count but those whose crc32(doc_id) mod 3 is 1, in steps
    of STEP; the driver gets a row per step. Without good or without bad ones it is THRESHOLD.
    """
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("quality"))
    step = F.floor(F.col("ratio") / STEP).cast("long").alias("step")
    met = ratios.where(remainder(F.col("doc_id"), 3) != 1).join(known, "doc_id").where("quality <> 0.5")
    rows = met.groupBy(step).agg(F.sum((F.col("quality") > 0.5).cast("long")).alias("good"), F.count("*").alias("n")).collect()
    found = sorted((r["step"], r["good"], r["n"] - r["good"]) for r in rows)
    at, good, bad = (np.array([r[i] for r in found], float) for i in range(3))
    if not len(found) or not good.sum() or not bad.sum():
        return THRESHOLD
    # Cutting above step i leaves all later ones; cutting below the first leaves all.
    lost = np.append(0, np.cumsum(good) / good.sum())
    gain = np.where(lost <= LOST, np.append(0, np.cumsum(bad) / bad.sum()) - lost, -np.inf)
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    low = np.append(at[:1] - 1, at)[best] + 1
    high = np.append(at, at[-1:] + 1)[best]
    widest = int((high - low).argmax())
    if best[widest] == 0:  # no cut is better than none
        return min(THRESHOLD, float(at[0]) * STEP)
    return round(float(low[widest] + high[widest]) / 2 * STEP, 4)


def _measured(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of ``quality_rules`` but its verdict for rows (key, text), written; ``key`` is carried along.

    Written, as else a filter on them would be moved below the steps and compute them again for each word.
    """
    # One constant of BUCKETS numbers; Spark folds it before it reads any row.
    ratios = F.split(F.lit(",".join(map(str, log_ratios(docs.select("key.doc_id", "text"), labels)))), ",").cast("array<double>")
    text = F.coalesce("text", F.lit(""))
    split = docs.select("key", text.alias("text")).withColumn("w", word_array(F.col("text")))
    lines = F.filter(F.split("text", "\n"), has_word)
    counted = split.withColumn("lines", lines).select(
        "key",
        "w",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    window = F.transform(head(F.col("h"), F.size("h") - 2), lambda x, i: F.xxhash64(x, F.get("h", i + 1), F.get("h", i + 2)))
    hashed = _grams(counted).withColumn("windows", window).drop("w", "h")
    # Most texts repeat no window and stop here; in the others equal windows meet by sorting.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    total = F.aggregate("grams", F.lit(0.0), lambda a, b: a + F.get(ratios, b))
    scored = hashed.select(
        "key", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.when(F.size("grams") > 0, total / F.size("grams")).otherwise(0.0).alias("ratio"),
        F.when(repeats, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("s"),
    )
    twice = lambda e, j: F.get("s", j - 1)["h"].eqNullSafe(e["h"]) | F.get("s", j + 1)["h"].eqNullSafe(e["h"])
    placed = scored.withColumn("places", F.sort_array(F.transform(F.filter("s", twice), lambda e: e["i"]))).drop("s")
    # A repeated window covers three words, or as many as there are before the next one begins.
    covered = F.transform("places", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("places", j + 1) - p, F.lit(3))))
    repeated = F.coalesce(F.aggregate(covered, F.lit(0), lambda a, b: a + b), F.lit(0)).cast("long")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return saved(
        placed.withColumn("n_repeat_words", repeated)
        .withColumn("base_failed", failed)
        .select("key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.round("ratio", 9).alias("ratio"))
    )


def _judged(docs: DataFrame, labels: DataFrame, threshold: float | None) -> DataFrame:
    measured = _measured(docs, labels)
    if threshold is None:
        threshold = best_threshold(measured.where("NOT base_failed").select(F.col("key.doc_id").cast("long").alias("doc_id"), "ratio"), labels)
    kept = ~F.col("base_failed") & (F.col("ratio") >= threshold)
    return measured.select("key", *measured.columns[1:-1], kept.alias("kept"), "ratio")


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, ratio.

    ``base_failed``: fewer than 50 words, or more than half of the words in three-word windows that occur
    twice or more in the text. ``ratio`` is the mean of ``log_ratios`` over the text's n-grams: below 0
    the text is more like the rest of the corpus than like the target. ``kept`` needs both: the rules
    are passed and ``ratio`` is at least ``threshold``, by default the ``best_threshold`` of this corpus. Every document is judged by
    the same number; nothing is drawn.

    Null texts have no words. A text without n-grams has ratio 0. Without trusted documents all ratios are
    0. Rows that repeat an id are judged each. An empty table gives an empty one.
    """
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    judged = _judged(docs.select(F.struct(doc_id).alias("key"), "text"), labels, threshold)
    return judged.select("key.doc_id", *judged.columns[1:])


def keep_by_rules(docs: DataFrame, labels: DataFrame, threshold: float | None = None) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, all columns as they are."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return _judged(docs.select(F.struct(*columns).alias("key"), "text"), labels, threshold).where("kept").select("key.*")
