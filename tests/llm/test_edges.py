"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for every operator and stage."""

import math

import public_tokenizers
import pytest

import corpus_pipeline
from dealerlake.llm.fingerprints import fingerprints
from dealerlake.llm.mixing import mix, mixed_rows
from dealerlake.llm.near_duplicates import keep_one, near_duplicates
from dealerlake.llm.packing import pack, sequences
from dealerlake.llm.quality_model import keep_good, quality
from dealerlake.llm.quality_rules import keep_by_rules, log_ratios, quality_rules
from dealerlake.llm.token_counts import token_counts
from dealerlake.llm.toxicity import toxicity
from dealerlake.llm.url_rules import judge_urls
from pyspark.sql import functions as F

BPE = public_tokenizers.path("byte_bpe_50k.json")
FOLDED = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"word{i % 5000}" for i in range(60_000))
ROWS = [
    (1, "one two three four five six", "en", "a", 5),
    (1, "one two three four five six", "en", "a", 5),  # a repeated row
    (2, None, None, None, None),
    (3, "", "en", "", 0),
    (4, " \n\t ", "en", "a", 4),
    (5, LONG, "en", "b", len(LONG)),
    (6, "ONE two three four five six", "fr", "b", 5),
    (None, "no id at all here", "en", None, 3),
    (7, "naïve 中文 <|endoftext|> it's", None, "b", 9),
]
# Names that operators use for columns of their own.
CLASH = ["score", "kept", "n_tokens", "component_id", "node", "sequence_id", "w", "text_", "copies", "row"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("own") for c in CLASH})


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (1, 0, None), (3, 0, 1), (5, 1, 0), (None, 1, 1), (6, None, None), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def ids(df):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in df.collect())


ALL = sorted((r[0] is None, r[0] or 0) for r in ROWS)


def test_scores(docs, labels):
    for out in (quality(docs, labels), toxicity(docs, labels)):
        assert ids(out) == ALL
        assert all(0 <= r.score <= 1 for r in out.collect())
        assert out.schema == type(out.schema)(out.schema.fields)
    assert quality(docs.limit(0), labels).collect() == []
    nothing = quality(docs, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in nothing} == {(0.5, 1)}
    assert toxicity(docs, labels.limit(0)).where("score <> 0.5").count() == 0
    assert keep_good(docs, labels).columns == docs.columns
    assert keep_good(docs, labels.limit(0)).count() == len(ROWS)


def test_quality_rules(docs, labels):
    out = {r.doc_id: r for r in quality_rules(docs, labels).collect()}
    assert len(out) == len(set(ALL)) and ids(quality_rules(docs, labels)) == ALL
    assert (out[2].n_words, out[2].word_chars, out[2].n_repeat_words, out[2].base_failed, out[2].kept) == (0, 0, 0, True, False)
    assert (out[1].n_words, out[1].word_chars, out[5].n_words, out[5].n_repeat_words) == (6, 22, 60_000, 60_000)
    assert quality_rules(docs.limit(0), labels).collect() == []
    assert all(r.ratio == 0 for r in quality_rules(docs, labels.limit(0)).collect())
    assert keep_by_rules(docs, labels).columns == docs.columns


def test_all_trusted_documents_are_counted(spark):
    many = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("same words here").alias("text"), F.lit(1).alias("quality"))
    # Target and corpus are the same texts.
    assert set(log_ratios(many.select("doc_id", "text"), many.select("doc_id", "quality"))) == {0.0}


def test_near_duplicates(docs):
    out = near_duplicates(docs, 85, 3)
    assert ids(out) == ALL
    assert {r.doc_id: (r.component_id, r.kept) for r in out.collect()} == {
        1: (1, True), 2: (2, True), 3: (3, True), 4: (4, True), 5: (5, True), 6: (1, False), 7: (7, True), None: (None, True),
    }
    assert near_duplicates(docs.limit(0)).collect() == []
    kept = keep_one(docs)
    assert kept.columns == docs.columns and ids(kept) == sorted({a for a in ALL if a != (False, 6)})


def test_mixing(docs):
    one = docs.withColumn("sources", F.array("source"))
    chosen, sizes, goal = mix(one, lambda names: {n: i + 1.0 for i, n in enumerate(names)})
    assert ids(chosen) == ALL and sizes[None] == 5 and sizes[""] == 0
    for source in sizes:
        taken = sum(r.taken for r in chosen.collect() if r.sources == [source])
        assert abs(taken - goal[source]) < 1.01
    assert all(r.taken <= 3 * r["size"] for r in chosen.collect())
    again, _, _ = mix(one, lambda names: {n: i + 1.0 for i, n in enumerate(names)})
    key = lambda r: (r.doc_id or 0, r["size"], r.taken)
    assert sorted(map(key, chosen.collect())) == sorted(map(key, again.collect()))
    assert mix(one.limit(0))[0].collect() == []
    assert mixed_rows(docs).columns == docs.columns and mixed_rows(docs.limit(0)).collect() == []


def test_overlapping_sources(spark):
    """The small source is met from documents it shares with a large one, which has others."""
    rows = [(i, "w " * 10, ["big"]) for i in range(10)] + [(100 + i, "w " * 10, ["big", "small"]) for i in range(4)] + [(200, "w " * 10, ["small"])]
    chosen, sizes, goal = mix(spark.createDataFrame(rows, "doc_id long, text string, sources array<string>"), total=1.0)
    assert (sizes, goal) == ({"big": 140, "small": 50}, {"big": 75.0, "small": 75.0})
    taken = {tuple(p): sum(r.taken for r in chosen.collect() if tuple(r.sources) == p) for p in (("big",), ("small",), ("big", "small"))}
    # 50 fresh words for the small source, then 25 repeated; nothing of the large source is repeated.
    assert sum(taken.values()) == 150 and taken["big",] == 75 and taken["small",] + taken["big", "small"] == 75
    assert taken["small",] <= 20 or taken["big", "small"] <= 80


def test_packing(docs):
    pieces = pack(docs, BPE).collect()
    per_doc = {}
    for r in sorted(pieces, key=lambda r: r.start):
        per_doc.setdefault(r.doc_id, []).append(r)
    assert sum(r.length for r in per_doc[2]) == 1 and per_doc[2][0].ids == b"\x01\0\0\0"
    assert sum(r.length for r in per_doc[1]) == 2 * per_doc[1][0].doc_tokens  # the repeated row is packed twice
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    for doc_id in (5, 7):
        joined = b"".join(bytes(r.ids) for r in per_doc[doc_id])
        assert [int.from_bytes(joined[i : i + 4], "little") for i in range(0, len(joined), 4)] == [*tokenizer.encode(dict((r[0], r[1]) for r in ROWS)[doc_id], add_special_tokens=False).ids, 1]
    lengths = {r.sequence_id: len(r.ids) // 4 for r in sequences(pack(docs, BPE)).collect()}
    assert all(n == 2048 or n & (n - 1) == 0 for n in lengths.values()) and sum(lengths.values()) == sum(r.length for r in pieces)
    assert pack(docs.limit(0), BPE).collect() == []


def test_token_counts(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(FOLDED)
    out = token_counts(docs, FOLDED)
    assert ids(out) == ALL
    texts = {r[0]: r[1] or "" for r in ROWS}
    for r in out.collect():
        n = len(tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 2048)
    assert token_counts(docs.limit(0), FOLDED).collect() == []


def test_fingerprints(docs):
    out = fingerprints(docs)
    assert ids(out) == ALL
    by = {r.doc_id: r for r in out.collect()}
    assert by[2].fingerprint == "" and by[2].n_chars == 0 and by[2].near_edited == 1
    assert by[3].fingerprint == by[4].fingerprint == ""  # neither has a word
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in by.values())
    assert by[5].near_edited > 0.1
    assert fingerprints(docs.limit(0)).collect() == []
    assert fingerprints(docs.where("doc_id = 5")).first().near_next == 1  # its own next document


def test_urls(spark):
    rules = [("com", "/", "allow"), ("a.com", "/x", "block"), ("A.com", "/x", "allow"), (None, "/", "block"), ("", "/", "block"), ("b.com", None, "block"), ("b.a.com", "", "block")]
    rules = spark.createDataFrame(rules, "host string, path string, verdict string")
    urls = [None, "", "no scheme", "http://", "http://COM", "http://com/", "http://b.a.com/x", "http://a.com/xy?://z/", "http://ba.com/x", "s://a.com?x/y", "http://a.com/" + "x" * 100_000]
    pages = spark.createDataFrame([(i, u, "own") for i, u in enumerate(urls)] + [(5, urls[5], "own"), (None, urls[5], "own")], "page_id long, url string, rule string")
    found = {r.page_id: (r.host, r.path[:6], r.rule, r.verdict) for r in judge_urls(pages, rules).collect()}
    assert judge_urls(pages, rules).count() == len(urls) + 2
    assert found[0] == found[1] == found[2] == ("", "", None, "allow") and found[4] == ("com", "", None, "allow")
    assert found[5] == found[None] == ("com", "/", "com/", "allow")
    assert found[6] == ("b.a.com", "/x", "b.a.com", "block")  # as long as a.com/x, with the longer host
    assert found[7][2:] == ("a.com/x", "allow") and found[8][2:] == ("com/", "allow") and found[9] == ("a.com", "", None, "allow")
    assert found[10][2:] == ("a.com/x", "allow")
    assert judge_urls(pages.limit(0), rules).collect() == []
    assert {r.verdict for r in judge_urls(pages, rules.limit(0), "block").collect()} == {"block"}


def test_url_rules_by_brute_force(spark):
    import random

    draw = random.Random(4)
    hosts = [".".join(draw.choices("ab", k=draw.randint(1, 4))) for _ in range(60)]
    paths = ["/" + "".join(draw.choices("xy/", k=draw.randint(0, 4))) for _ in range(60)]
    rules = sorted({(draw.choice(hosts), draw.choice(paths)) for _ in range(40)})
    pages = [(i, f"http://{draw.choice(hosts)}{draw.choice(paths)}") for i in range(2000)]
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    table = spark.createDataFrame([(h, p, f"v{i}") for i, (h, p) in enumerate(rules)], "host string, path string, verdict string")
    for r in judge_urls(spark.createDataFrame(pages, "page_id long, url string"), table).collect():
        fit = [(len(h) + len(p), len(h), f"v{i}") for i, (h, p) in enumerate(rules) if (r.host == h or r.host.endswith("." + h)) and r.path.startswith(p)]
        assert r.verdict == (max(fit)[2] if fit else "allow")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_pipeline_stages(spark, docs, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for table in (docs, docs.limit(0)):
        rows = table
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, str(tmp_path))
            out.write.mode("overwrite").parquet(str(tmp_path / name))
            assert name == "packing" or out.columns == docs.columns
            # The next stage is tried on all rows, since the rules leave none of so few words.
            rows = table
    assert all(math.isfinite(r["length"]) for r in out.collect())
