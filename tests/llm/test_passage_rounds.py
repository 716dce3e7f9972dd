"""Passages whose leaders are unrelated, adjacent passages, and partners with partial copies or repeated shingles."""

import random

import numpy as np
import pytest

from meterlake.llm import compact_windows
from tests.llm.test_operators import prose


def jaccard_places(p, q, width, similarity):
    flags = np.zeros(len(p), bool)
    for a in range(len(p) - width + 1):
        x = set(p[a:a + width].tolist())
        for b in range(len(q) - width + 1):
            y = set(q[b:b + width].tolist())
            if len(x & y) >= similarity * len(x | y) - 1e-9:
                flags[a:a + width] = True
                break
    return flags


@pytest.mark.parametrize("seed", range(12))
def test_near_stretches_are_those_of_brute_force(seed):
    rng = np.random.default_rng(seed)
    width, kinds = 12, 6 if seed % 3 == 0 else 1000
    p = rng.integers(0, kinds, 80).astype(np.uint64)
    q = np.concatenate([p[20:28], rng.integers(0, kinds, 9).astype(np.uint64), p[15:50], p[18:26]])
    q[[20, 33]] = 5000
    q = np.delete(q, 40)
    for x, y in ((p, q), (q, p)):
        assert (compact_windows.near_stretches(x, y, width, 0.8) == jaccard_places(x, y, width, 0.8)).all()


def test_adjacent_passages_of_different_partners(spark):
    rng = random.Random(8)
    x, y = prose(rng, 60), prose(rng, 60)
    texts = [x + " " + y, prose(rng, 40) + " " + x + " " + prose(rng, 200), y + " " + prose(rng, 40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {r["doc_id"]: r for r in compact_windows.near_duplicate_passages(df).collect()}
    assert got[0]["passage_words"] == 120 and got[1]["passage_words"] >= 60 and got[2]["passage_words"] >= 60
    assert {r["class_id"] for r in got.values()} == {0}


def test_passage_of_common_shingles_with_unrelated_leaders(spark):
    rng = random.Random(6)
    phrases = [prose(rng, 8) for _ in range(7)]
    passage = " ".join(phrases)
    texts = [prose(rng, 20) + " " + passage + " " + prose(rng, 15), passage + " " + prose(rng, 30)]
    # each phrase also lies in long documents that share long passages of their own
    for phrase in phrases:
        own = prose(rng, 220)
        texts += [own + " " + phrase + " " + prose(rng, 70) for _ in range(2)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in compact_windows.near_duplicate_passages(df).collect()}
    assert got[0]["passage_words"] >= 56 and got[1]["passage_words"] >= 56
    assert got[0]["class_id"] == got[1]["class_id"] == 0


def test_second_passage_of_a_confirmed_stretch(spark):
    rng = random.Random(12)
    x, y = prose(rng, 60), prose(rng, 54).split(" ")
    texts = [x + " " + " ".join(y), prose(rng, 30) + " " + x, " ".join(y) + " " + prose(rng, 20)]
    # every shingle of y is also found in two long documents that lead its signatures and hold nothing else of y
    for k in range(50):
        own = " ".join(prose(rng, 100) + " " + " ".join(y[k:k + 5]) for _ in range(4)) + " " + prose(rng, 100)
        texts += [own + " " + prose(rng, 20) for _ in range(2)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in compact_windows.near_duplicate_passages(df).collect()}
    assert got[0]["passage_words"] == 114 and got[2]["passage_words"] >= 54
    assert [got[k]["class_id"] for k in range(3)] == [0, 0, 0]
