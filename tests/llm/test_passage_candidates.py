"""Passage candidates: common lines make no pairs, and texts with repeats lose none."""

import random

import numpy as np
import pyarrow as pa

from meterlake.llm import compact_windows
from tests.llm.test_operators import prose
from tests.llm.test_passage_rounds import jaccard_places


def test_common_line_is_compared_with_nothing(spark, monkeypatch):
    rng = random.Random(31)
    line = prose(rng, 30)
    texts = [f"{prose(rng, 70)} {line} {prose(rng, 70)}" for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    compared, confirmed = [], compact_windows.NearPassages.confirmed

    def counted(self, passages, pairs):
        compared.append(pairs.count())
        return confirmed(self, passages, pairs)

    monkeypatch.setattr(compact_windows.NearPassages, "confirmed", counted)
    got = compact_windows.near_duplicate_passages(df).collect()
    assert sum(compared) == 0
    assert [(r["n_words"], r["n_passages"], r["class_id"] == r["doc_id"]) for r in got] == [(170, 0, True)] * 30


def test_passages_of_texts_with_repeats_are_those_of_brute_force(spark):
    rng = random.Random(17)
    texts = []
    for _ in range(6):
        own = prose(rng, 40).split(" ")
        again = own[:14] + own[6:14] + own[14:]  # shingles come twice within a stretch
        texts += [own, again, [*own[:20], "other", *own[21:]], prose(rng, 20).split(" ") + again[3:30]]
    df = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["passage_words"] for r in compact_windows.near_duplicate_passages(df, passage=20, similarity=0.6).collect()}
    h, first, _ = compact_windows.shingles(pa.array([" ".join(t) for t in texts]), compact_windows.SHINGLE)
    own = [h[a:b] for a, b in zip(first[:-1], first[1:])]
    for k, p in enumerate(own):
        flags = np.zeros(len(texts[k]), bool)
        for q in own[:k] + own[k + 1:]:
            for a, b in compact_windows.runs_of(jaccard_places(p, q, 16, 0.6)):
                flags[a:b + compact_windows.SHINGLE - 1] = True
        assert got[k] == flags.sum(), k
