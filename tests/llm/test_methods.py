"""Operators against plain versions on the given tables, and held-out accuracy."""

import hashlib

import numpy as np
import pytest

from dealerchecks.compare import connect, difference
from dealerlake.llm import near_duplicates as near
from dealerlake.llm.packing import Schedule
from dealerlake.llm.queries import llm_queries, llm_sql
from tests.llm import brute

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def test_near_duplicates(spark, texts, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 4)
    labels = brute.groups(texts, 85, 3)
    out = near.near_duplicates(spark.read.parquet(f"{FOLDER}/documents.parquet"), 85, 3).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out} == {i: (len(brute.shingles(t, 3)), labels[i], labels[i] == i) for i, t in texts.items()}


def test_rules(spark, texts):
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    for r in llm_queries()["op7_quality_rules"](spark, FOLDER).collect():
        text = texts[r.doc_id]
        w, repeated = brute.WORD.findall(text), brute.repeated_words(brute.WORD.findall(text))
        lines = [x for x in text.split("\n") if brute.WORD.search(x)]
        expected = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeated)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (len(w) < 50 or 100 * repeated > 50 * len(w))
        if not r.base_failed and r.doc_id in quality:
            assert r.kept == bool(quality[r.doc_id])


def test_fingerprints(spark, texts):
    order = sorted(texts, reverse=True)
    follows = dict(zip(order, order[1:] + order[:1]))
    out = llm_queries()["op6_fingerprints"](spark, FOLDER).collect()
    seen = {}
    for r in out:
        text, other = texts[r.doc_id], texts[follows[r.doc_id]]
        third = len(text) // 3
        edited = text[: len(text) - third] + other[:third]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert seen.setdefault(text, r.fingerprint) == r.fingerprint
    long = [r for r in out if r.n_chars > 500]
    assert np.median([r.near_edited for r in long]) > 0.2 and max(r.near_next for r in long if texts[r.doc_id] != texts[follows[r.doc_id]]) < 0.5
    assert np.median([r.near_next for r in long]) < 0.02


def test_held_out_quality(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = [r for r in llm_queries()["op1_quality"](spark, FOLDER).collect() if r.held_out and r.doc_id in labels]
    assert len(rows) > 50 and np.mean([r.predicted == labels[r.doc_id] for r in rows]) > 0.95


def test_held_out_toxicity(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = [r for r in llm_queries()["op3_toxicity"](spark, "/root/testdata/sf0.1").collect() if r.held_out and r.doc_id in labels]
    assert np.mean([r.toxic for r in rows if labels[r.doc_id]]) > 0.9
    assert np.mean([r.toxic for r in rows if not labels[r.doc_id]]) < 0.02


def test_mixing_meets_targets(spark):
    rows = llm_queries()["op4_mixing"](spark, FOLDER).toPandas()
    per = rows.groupby("source").agg(size=("size", "sum"), own=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    assert (per["size"] == per.own).all() and (abs(per.taken - per.target) < 2).all() and (rows.taken <= 3 * rows["size"]).all()


@pytest.mark.parametrize("name", sorted(llm_sql()))
def test_sql(spark, name):
    assert difference(spark, connect(FOLDER), llm_queries()[name], llm_sql()[name], FOLDER) is None


@pytest.mark.parametrize("seed", range(20))
def test_schedule(seed):
    draw = np.random.RandomState(seed)
    totals = draw.choice([1, 3, 50, 900, 5000], draw.randint(1, 7)).tolist()
    length = int(draw.choice([8, 64, 256]))
    plan = Schedule(totals, [float(x) for x in (totals if seed % 2 else draw.choice([0, 1, 5], len(totals)))], length, least=int(draw.choice([1, 32])))
    held = {}
    for source, total in enumerate(totals):
        begin = np.unique(np.append(0, draw.randint(0, total, 20)))
        size = np.diff(np.append(begin, total))
        doc, start, n, sequence, offset = plan.pieces(source, begin, size)
        for i in range(len(begin)):
            mine = np.flatnonzero(doc == i)
            mine = mine[np.argsort(start[mine])]
            assert (start[mine] == np.append(0, np.cumsum(n[mine]))[:-1]).all() and n[mine].sum() == size[i]
        for row in zip(sequence, offset, n):
            held.setdefault(row[0], []).append(row[1:])
    for sequence, rows in held.items():
        rows.sort()
        ends = np.cumsum([n for _, n in rows])
        assert [o for o, _ in rows] == [0, *ends[:-1]]
        assert ends[-1] == length if sequence < sum(totals) // length else ends[-1] & (ends[-1] - 1) == 0
