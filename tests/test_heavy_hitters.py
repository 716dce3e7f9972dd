"""Exact top values through a frequency sketch, against plain counts."""

import random
from collections import Counter

import pytest

from meterlake.operators import eda
from scripts.plans import plan_text


def _frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "`energy(kWh/hh)` string")


def _want(values, k):
    order = sorted(Counter(values).items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))
    return order[:k]


def _skewed(seed, n):
    rng = random.Random(seed)
    hot = [None, "Null", "", "0.1", "0.2", "0.25"]
    return [rng.choice(hot) if rng.random() < 0.4 else f"{rng.randrange(n)}" for _ in range(n)]


CASES = {
    "skewed": _skewed(1, 5000),
    "one value": ["0.5"] * 300,
    "all distinct": [f"{i}" for i in range(500)],
    "ties at the border": [f"{i % 40}" for i in range(400)],
    "nulls only": [None] * 20,
    "fewer values than k": ["a", "b", "b", None],
    "empty": [],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("cells", [1, 7, eda.SKETCH_CELLS])
def test_top_values_equal_plain_counts(spark, monkeypatch, name, cells):
    monkeypatch.setattr(eda.heavy_hitters, "__defaults__", (cells,))
    got = [tuple(r) for r in eda.top_values(_frame(spark, CASES[name])).collect()]
    assert got == _want(CASES[name], 10)


def test_only_candidates_are_shuffled(spark):
    """A light value shares no cell with a heavy one here, so it never leaves its task."""
    values = [f"hot{i}" for i in range(10)] * 100 + [f"{i}" for i in range(2000)]
    kept = eda.heavy_hitters(_frame(spark, values).withColumnRenamed("energy(kWh/hh)", "energy"), "energy", 10)
    left = Counter(r["energy"] for r in kept.collect())
    assert all(left[f"hot{i}"] == 100 for i in range(10)) and len(left) < 20


def test_candidates_are_filtered_before_the_exchange(spark):
    plan = plan_text(eda.top_values(_frame(spark, CASES["skewed"])))
    main = plan[plan.index("HashAggregate"):]
    assert "LeftSemi" in main and "BroadcastHashJoin" in main
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
