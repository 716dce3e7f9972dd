"""Selector of personal data: trained on every candidate, whatever the number of documents and however rows are dealt."""

import random

import numpy as np
import pytest

from meterlake.llm import pii_boost

N = 12_500


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    texts = []
    for k in range(N):
        key = "".join(rng.choice("0123456789abcdef") for _ in range(24))
        texts.append(f"{rng.choice(['token = ', 'api key: ', 'see ', 'run '])}{key}a1 number {k}")
    return spark.createDataFrame(list(enumerate(texts + texts[:50] + [None, "", "nothing here"])), "doc_id long, text string")


def test_every_candidate_of_every_different_text_is_a_training_row(docs):
    texts = {r["text"] for r in docs.collect()} - {None}
    want = sum(len(pii_boost.candidates(t)) for t in texts)
    rows = pii_boost.training_rows(docs)
    assert want >= N and rows.count() == want


def test_trees_and_threshold_are_those_of_all_rows_however_they_are_dealt(docs, monkeypatch):
    told = pii_boost.fit_selector(docs.repartition(7))
    rows = pii_boost.training_rows(docs).collect()
    trees = pii_boost.BoostedTrees()
    train = [r for r in rows if not r["held"]]
    inner = np.linspace(0, 1, trees.bins + 1)[1:-1]
    for k in range(len(pii_boost.FEATURES)):
        want = np.unique(np.quantile(np.array([r["x"][k] for r in train]), inner))
        assert told.trees.edges[k].tolist() == want.tolist(), k
    trees.edges = told.trees.edges
    binned = trees.bin(np.array([r["x"] for r in train]))
    y = np.array([r["label"] for r in train], float)
    trees.boost(float(y.mean()), lambda tree, nodes: trees.sums(tree, nodes, binned, np.ones(len(y)), y))
    assert told.trees.trees == trees.trees and told.trees.base == trees.base
    held = [r for r in rows if r["held"]]
    score = np.floor(trees.probability(np.array([r["x"] for r in held])) * pii_boost.STEPS) / pii_boost.STEPS
    assert told.threshold == pii_boost.calibrated_threshold(score, np.array([r["label"] for r in held], float))
    monkeypatch.setattr(pii_boost, "ROWS_PER_TASK", 500)  # several tasks a level
    monkeypatch.setattr(pii_boost.BoostedTrees.__init__, "__defaults__", (4, 3, 0.2, 32, 1.0))
    assert pii_boost.fit_selector(docs).trees.trees == trees.trees[:4]
