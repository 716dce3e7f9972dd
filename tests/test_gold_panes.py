"""Panes, windows rolled up from them, exact sums and the merged pane table, against brute force."""

import datetime as dt
import math
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from meterlake.functions import exact as X
from meterlake.operators import gold
from meterlake.streaming import jobs

SILVER = ("LCLid string, timestamp timestamp, consumption double, acorn_group string, temperature double, "
          "precipType string")
BASE = dt.datetime(2024, 1, 1)


def silver(spark, seed, n=3000, days=1):
    rng = random.Random(seed)
    values = [None, float("nan"), float("inf"), -0.1234567, 1e-9, 3.3e8, 2e9, 0.1, -5e-13]
    return spark.createDataFrame([(
        rng.choice([None, "hot", "hot", *(f"m{i}" for i in range(25))]),
        None if rng.random() < 0.01 else BASE + dt.timedelta(seconds=rng.randint(0, days * 86_400)),
        rng.choice(values) if rng.random() < 0.2 else round(rng.random() * 9, 7),
        rng.choice("ab"), rng.choice([None, 1.3, -20.17]), rng.choice([None, "rain"])) for _ in range(n)], SILVER)


def brute(df, window, slide):
    """Windows by Spark's own sliding window, whose groups are then looked at reading by reading."""
    usable = F.when(F.abs("consumption") <= 1e9, F.col("consumption"))
    rows = df.groupBy(F.window("timestamp", window, slide).alias("window"), *gold.KEYS).agg(
        F.count_distinct("LCLid").alias("meters"), F.collect_list(usable).alias("x"), F.collect_list("temperature").alias("t"))
    return {(r["window"]["start"], r["window"]["end"], r["acorn_group"], r["precipType"]): r for r in rows.collect()}


def by_key(df):
    return {(r["window"]["start"], r["window"]["end"], r["acorn_group"], r["precipType"]): r for r in df.collect()}


def assert_exact(got, want):
    assert got.keys() == want.keys()
    for k, r in got.items():
        x, t = want[k]["x"], want[k]["t"]
        assert r["active_meters"] == want[k]["meters"]
        assert r["total_load"] == (math.fsum(x) if x else None)
        assert r["avg_consumption"] == (math.fsum(x) / len(x) if x else None)
        assert r["avg_temp"] == (math.fsum(t) / len(t) if t else None)


@pytest.mark.parametrize("window,slide", [("1 hour", "30 minutes"), ("90 minutes", "20 minutes"),
                                          ("3 hours", "30 minutes"), ("30 minutes", "30 minutes")])
def test_windows_of_panes_equal_windows_of_readings(spark, window, slide):
    df = silver(spark, 1)
    got = by_key(gold.gold_kpis(df, window, slide, approx_meters=False, exact_scale="exact"))
    assert_exact(got, brute(df, window, slide))


def test_plain_and_approximate_gold(spark):
    df = silver(spark, 2).filter("abs(consumption) <= 1e9")
    want = brute(df, "1 hour", "30 minutes")
    for r in gold.gold_kpis(df).collect():
        w = want.pop((r["window"]["start"], r["window"]["end"], r["acorn_group"], r["precipType"]))
        assert math.isclose(r["total_load"], math.fsum(w["x"]), rel_tol=1e-12, abs_tol=1e-9)
        assert abs(r["active_meters"] - w["meters"]) <= 0.2 * w["meters"] + 1
    assert not want
    assert gold.gold_kpis(df.limit(0)).count() == gold.gold_kpis(df.limit(0), approx_meters=False).count() == 0


def test_exact_sums_do_not_depend_on_order_or_partitions(spark):
    rng = random.Random(3)
    xs = [rng.choice([1, -1]) * rng.random() * 10.0 ** rng.randint(-12, 8) for _ in range(20_000)]
    xs += [1e8, 1e-9, -1e8] * 50 + [0.1234567] * 77 + [-2.0 ** -40]
    want = math.fsum(xs)
    for parts in (1, 7):
        rng.shuffle(xs)
        df = spark.createDataFrame([(x,) for x in xs], "x double").repartition(parts)
        assert df.agg(*X.limb_sums("x", "s")).select(X.limb_total("s")).first()[0] == want
    halves = spark.createDataFrame([(i % 2, x) for i, x in enumerate(xs)], "k int, x double").groupBy("k").agg(*X.limb_sums("x", "s"))
    assert halves.agg(*X.merged_limbs("s")).select(X.limb_total("s")).first()[0] == want
    none = spark.createDataFrame([(None,), (float("nan"),), (1e300,)], "x double")
    assert none.agg(*X.limb_sums("x", "s")).select(X.limb_total("s")).first()[0] is None


@pytest.mark.parametrize("xs", [[-0.3], [-1e-13, 5e-13], [0.1, 0.2, -0.3], [-7.25], [0.0], [-(2.0 ** 29) - 0.5, 1e-13]])
def test_exact_sums_of_few(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert df.agg(*X.limb_sums("x", "s")).select(X.limb_total("s")).first()[0] == math.fsum(xs)


def files_under(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


@pytest.mark.parametrize("by_meter", [True, False])
def test_merged_pane_table_stays_bounded(spark, tmpdir_path, by_meter):
    """Twenty batches that change the same two days leave the newest row of each pane and no older files."""
    path, seen, sizes = f"{tmpdir_path}/gold", None, []
    for n in range(20):
        part = silver(spark, n, 60, days=2)
        seen = part if seen is None else seen.unionByName(part)
        seen = spark.createDataFrame(seen.collect(), SILVER)
        panes = gold.gold_panes(seen, by_meter=by_meter, sums="exact")
        # what an update-mode stream hands over: the whole new rows of the panes this batch touched
        touched = gold.gold_panes(part, by_meter=by_meter, sums="exact")
        keys = [k for k in jobs.PANE_KEYS if k in panes.columns]
        same = [panes[k].eqNullSafe(touched[k]) for k in keys]
        jobs.merge_panes(spark, panes.join(touched, same, "left_semi"), path, n)
        sizes.append(len(files_under(path)))
    want = gold.roll_windows(gold.gold_panes(seen, by_meter=by_meter, sums="exact"), by_meter=by_meter, sums="exact")
    got = jobs.read_gold(spark, path)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    assert max(sizes[3:]) <= 2 * min(sizes[3:])
    assert sorted(os.listdir(f"{path}/staged")) == [f"batch={19:020d}"] and os.listdir(f"{path}/changes") == []


def test_publication_that_died_is_repeated(spark, tmpdir_path):
    path = f"{tmpdir_path}/gold"
    first, second = silver(spark, 1, 200, days=3), silver(spark, 2, 200, days=3)
    jobs.merge_panes(spark, gold.gold_panes(first, sums="exact"), path, 0)
    both = gold.gold_panes(first.unionByName(second), sums="exact")
    jobs.merge_panes(spark, both, path, 1)
    want = sorted(map(repr, jobs.read_gold(spark, path).collect()))
    # the run ended after it had dropped one day's old partition
    shutil.rmtree(f"{path}/panes/day=2024-01-02")
    assert sorted(map(repr, jobs.read_gold(spark, path).collect())) != want
    jobs.merge_panes(spark, both.limit(0), path, 1)
    assert sorted(map(repr, jobs.read_gold(spark, path).collect())) == want
    jobs.merge_panes(spark, both.limit(0), path, 2)  # an empty batch changes nothing
    assert sorted(map(repr, jobs.read_gold(spark, path).collect())) == want


def test_days_without_changes_are_not_rewritten(spark, tmpdir_path):
    path, df = f"{tmpdir_path}/gold", silver(spark, 5, 400, days=3)
    jobs.merge_panes(spark, gold.gold_panes(df), path, 0)
    before = {f: os.stat(f).st_mtime_ns for f in files_under(f"{path}/panes") if "day=2024-01-02" not in f}
    jobs.merge_panes(spark, gold.gold_panes(df.filter("date(timestamp) = '2024-01-02'")), path, 1)
    assert before == {f: os.stat(f).st_mtime_ns for f in files_under(f"{path}/panes") if "day=2024-01-02" not in f}
