import math

import pytest
from pyspark.sql import functions as F

from dealerlake.llm import katz
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("fast", [0, 40, 65_533])
def test_scores_agree_with_dictionaries(spark, monkeypatch, fast):
    """Whatever number of words has numbers, every pair keeps its own count."""
    monkeypatch.setattr(katz, "FAST", fast)
    monkeypatch.setattr(katz, "PER_BUCKET", 20_000)
    monkeypatch.setattr(katz, "TASKS", 3)
    monkeypatch.setattr(katz, "FREQUENT_PAIRS", 50)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = brute.Katz([t for i, t in texts.items() if brute.fold(i, 7) != 2])
    rows = katz.language_model(docs).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        text = texts[r.doc_id]
        tokens = [*brute.words(text), "</s>"]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (brute.fold(r.doc_id, 7) == 2, len(tokens), model.total)
        assert r.n_known == sum(model.count.get(w, 0) > 0 for w in tokens)
        assert math.isclose(r.base_score, model.base(text), rel_tol=1e-9, abs_tol=1e-7)
        assert math.isclose(r.score, model.score(text), rel_tol=1e-9, abs_tol=1e-7)


def test_probabilities_add_up():
    """What is left over is exactly what unseen words share."""
    model = brute.Katz(["a b a b c", "b a d e", "a a a b", "", "c c c d a b a b a b"])
    words = [w for w in model.count]
    for before in [*words, "<s>", "never seen"]:
        assert math.isclose(sum(model.next(before, w) for w in [*words, "<unknown>"]), 1, rel_tol=1e-9)


def test_edge_rows(spark):
    long = " ".join(f"w{i * i % 997} x" for i in range(150_000))
    rows = [(1, "a b a b", "x"), (1, "a b a b", "x"), (1, "other text", "x"), (3, None, "x"), (4, "", "x"), (5, " \n", "x"), (None, "a", "x"), (7, "zzz a", "x"), (8, long, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    docs = docs.withColumns({c: F.lit("own") for c in ("taught", "word", "block", "kind", "bucket", "a", "base", "n_tokens")})
    out = katz.language_model(docs).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in out) == [(0, 2), (1, 3), (1, 5), (1, 5), (3, 1), (4, 1), (5, 1), (7, 3), (8, 300_001)]
    assert len({(r.score, r.base_score) for r in out if (r.doc_id, r.n_tokens) == (1, 5)}) == 1
    model = brute.Katz([t for i, t, _ in rows if brute.fold(i, 7) != 2])
    texts = {(i, len(brute.words(t)) + 1): t for i, t, _ in rows}
    for r in out:
        assert math.isclose(r.score, model.score(texts[r.doc_id, r.n_tokens]), rel_tol=1e-9, abs_tol=1e-7)
    assert katz.language_model(docs.limit(0)).collect() == []
    taught = katz.score(docs, katz.train(docs, F.lit(False)), F.lit(False)).collect()
    assert {(r.score, r.n_known, r.train_tokens) for r in taught} == {(0.0, 0, 0)}
