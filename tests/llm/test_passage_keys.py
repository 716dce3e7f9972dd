"""Keys of passages: near stretches share them, and a group of near copies is not compared pair by pair."""

import random

import numpy as np
import pytest

from meterlake.llm import compact_windows
from tests.llm.test_operators import prose


@pytest.mark.parametrize("seed", range(12))
def test_near_stretches_share_keys(seed):
    rng = np.random.default_rng(seed)
    width, similarity = (1, 12, 12, 20)[seed % 4], (0.8, 0.8, 0.6)[seed % 3]
    base = rng.integers(0, 12 if seed % 2 else 4000, 60)
    texts = []
    for _ in range(24):
        own = base.copy()
        own[rng.integers(0, 60, int(rng.integers(0, 6)))] = rng.integers(5000, 5030)
        texts.append(own[int(rng.integers(0, 20)):])
    values = [set(t.tolist()) for t in texts]
    texts = [np.array([sum(v in x for x in values) << 48 | v for v in t.tolist()], np.uint64) for t in texts]
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    good = np.concatenate([np.arange(len(t)) + width <= len(t) for t in texts])
    keys = [set() for _ in texts]
    for row, key, _, kind, side in zip(*compact_windows.prefix_entries(np.concatenate(texts), first, good, width, similarity)):
        keys[row].add((int(kind), int(key), bool(side)))
    for i, p in enumerate(texts):
        for j, q in enumerate(texts[:i]):
            if compact_windows.near_stretches(p, q, width, similarity).any():
                both = {(k, z) for k, z, s in keys[i] if (k, z, not s if k == 1 else s) in keys[j]}
                assert len(both) >= compact_windows.SHARED or any(k == 3 for k, _ in both), (i, j)


def test_group_of_near_copies_is_compared_with_leaders(spark, monkeypatch):
    rng = random.Random(3)
    base, texts = prose(rng, 160).split(" "), []
    for _ in range(60):
        own = list(base)
        for at in rng.sample(range(160), 5):
            own[at] = prose(rng, 2).replace(" ", "")
        texts.append(" ".join(own))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    compared, confirmed = [], compact_windows.NearPassages.confirmed

    def counted(self, passages, pairs):
        compared.append(pairs.count())
        return confirmed(self, passages, pairs)

    monkeypatch.setattr(compact_windows.NearPassages, "confirmed", counted)
    got = compact_windows.near_duplicate_passages(df).collect()
    assert {r["class_id"] for r in got} == {0}
    assert sum(compared) < 60 * 59 / 4, compared
