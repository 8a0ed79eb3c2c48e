"""The pipeline stage by stage against plain versions, each on its own input."""

from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from dealerlake.llm.mixing import targets
from dealerlake.llm.packing import LENGTH
from dealerlake.llm.quality_model import quality
from dealerlake.llm.queries import one_two_three, tokenizer_file
from dealerlake.llm.quality_rules import quality_rules
from dealerlake.llm.store import saved
from tests.llm import brute

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    """Rows before the first and after each stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(saved(stage(spark, out[-1], FOLDER)))
    return out


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_every_stage_keeps_the_columns(steps):
    assert all(df.columns == steps[0].columns for df in steps[1:-1])
    whole = {r.doc_id: r for r in steps[0].collect()}
    assert all(whole[r.doc_id] == r for df in steps[1:-1] for r in df.collect())


def test_classifier_and_rules_drop_what_they_reject(spark, steps):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    assert ids(steps[1]) == ids(quality(steps[0], labels).where("predicted = 1"))
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert good <= set(ids(steps[1]))
    assert ids(steps[2]) == ids(quality_rules(steps[1], labels).where("kept"))
    failed = set()
    for r in steps[1].collect():
        w = brute.WORD.findall(r.text)
        if len(w) < 50 or 100 * brute.repeated_words(w) > 50 * len(w):
            failed.add(r.doc_id)
    assert not failed & set(ids(steps[2])) and good & set(ids(steps[1])) - failed <= set(ids(steps[2]))


def test_one_of_each_group_stays(steps):
    labels = brute.groups({r.doc_id: r.text for r in steps[2].collect()}, 80, 5)
    assert ids(steps[3]) == Counter(set(labels.values()))


def test_mix_meets_its_targets(steps):
    size, taken = Counter(), Counter()
    before = {}
    for r in steps[3].collect():
        before[r.doc_id] = len(brute.WORD.findall(r.text))
        size[r.source] += before[r.doc_id]
    for r in steps[4].collect():
        taken[r.source] += before[r.doc_id]
    goal = targets(size, one_two_three(sorted(size)), sum(size.values()))
    assert max(ids(steps[4]).values()) <= 3
    assert all(abs(taken[s] - goal[s]) <= 0.01 * goal[s] + 1 for s in goal)


def test_packing_holds_every_id_once(steps):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    rows = steps[4].collect()
    expected = sum(len(e.ids) + 1 for e in tokenizer.encode_batch([r.text for r in rows], add_special_tokens=False))
    pieces = steps[5].toPandas()
    assert pieces.length.sum() == expected
    per = pieces.sort_values("offset").groupby("sequence_id")
    for _, group in per:
        assert (group.offset.to_numpy() == np.append(0, np.cumsum(group.length))[:-1]).all()
    full = per.length.sum()
    assert (full == LENGTH).sum() == expected // LENGTH and all(n & (n - 1) == 0 for n in full)
