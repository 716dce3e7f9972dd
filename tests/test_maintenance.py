"""Compaction, retention listing, deletion; HyperLogLog bound of the approximate gold."""

import os
import time

from pyspark.sql import functions as F

from meterlake.operators import gold, maintenance
from meterlake.plans import layers

SF = "/root/testdata/sf0.001"


def test_compaction_keeps_rows_and_reduces_files(spark, tmpdir_path):
    src, dst = f"{tmpdir_path}/small", f"{tmpdir_path}/compact"
    s = layers.silver_layer(spark, SF)
    s.repartition(16).write.parquet(src)
    out = maintenance.compact(spark, src, dst)
    before = maintenance.fingerprint(spark.read.parquet(src)).first()
    after = maintenance.fingerprint(out).first()
    assert before == after
    n_src = maintenance.list_files(spark, src).count()
    n_dst = maintenance.list_files(spark, dst).count()
    assert n_src == 16 and n_dst == 1


def test_expired_files_and_delete(spark, tmpdir_path):
    table = f"{tmpdir_path}/gold"
    g = layers.gold_layer(spark, SF)
    g.repartition(3).write.parquet(f"{table}/snapshot=1")
    g.coalesce(1).write.parquet(f"{table}/snapshot=2")
    now = int(time.time() * 1000) + 1
    # Within retention: nothing expires.
    assert maintenance.expired_files(spark, table, retention_hours=1.0, now_ms=now).count() == 0
    exp = maintenance.expired_files(spark, table, retention_hours=0.0, now_ms=now)
    paths = [r["path"] for r in exp.collect()]
    assert len(paths) == 3 and all("snapshot=1" in p for p in paths)
    done = maintenance.delete_files(exp).collect()
    assert all(r["deleted"] for r in done)
    assert all(not os.path.exists(p.replace("file:", "")) for p in paths)
    # The live snapshot is untouched.
    assert spark.read.parquet(f"{table}/snapshot=2").count() == g.count()


def test_half_written_snapshot_expires_nothing_live(spark, tmpdir_path):
    table = f"{tmpdir_path}/gold"
    for n in (1, 2, 3):
        spark.range(10 * n).repartition(2).write.parquet(f"{table}/snapshot={n}")
    os.remove(f"{table}/snapshot=3/_SUCCESS")
    expired = maintenance.expired_files(spark, table, 0.0, int(time.time() * 1000) + 1).collect()
    assert len(expired) == 2 and all("/snapshot=1/" in r["path"] for r in expired)
    assert all("/snapshot=2/" in r["path"] for r in maintenance.live_files(spark, table).collect())
    os.remove(f"{table}/snapshot=2/_SUCCESS")
    os.remove(f"{table}/snapshot=1/_SUCCESS")
    assert maintenance.expired_files(spark, table, 0.0, int(time.time() * 1000) + 1).count() == 0
    assert maintenance.live_files(spark, table).count() == 0


def test_approx_meter_counts_within_error_bound(spark):
    s = layers.silver_layer(spark, "/root/testdata/sf0.01")
    a = gold.gold_kpis(s, approx_meters=True, exact_scale=3).withColumnRenamed("active_meters", "approx")
    e = gold.gold_kpis(s, approx_meters=False, exact_scale=3).select("window", "acorn_group", "precipType",
                                                                    F.col("active_meters").alias("exact"))
    j = a.join(e, [a["window"] == e["window"], a["acorn_group"].eqNullSafe(e["acorn_group"]),
                   a["precipType"].eqNullSafe(e["precipType"])])
    assert j.count() == a.count() == e.count()
    rel = F.abs(F.col("approx") - F.col("exact")) / F.col("exact")
    st = j.select(F.avg(rel).alias("mean"), F.max(F.when(F.col("exact") >= 20, rel)).alias("big"),
                  F.max(F.abs(F.col("approx") - F.col("exact"))).alias("abs")).first()
    assert st["mean"] <= 0.05            # the requested relative standard deviation
    assert (st["big"] or 0.0) <= 0.2     # 4 standard errors where the count is not tiny
    assert st["abs"] <= 3


def test_business_reports_equal_single_reports(spark):
    from meterlake.operators import detector, insights
    from meterlake.params import DetectorParams
    s, g = layers.silver_layer(spark, SF), layers.gold_layer(spark, SF)
    a = detector.anomaly_alerts(s, DetectorParams(calibration=30, z_mild=3.0, z_extreme=5.0))
    for exact in (True, False):
        reps = insights.business_reports(s, g, a, exact=exact)
        assert len(reps) == 9
        single = {"thermal_sensitivity": insights.thermal_sensitivity(s, exact), "volatility_index": insights.volatility_index(s, exact),
                  "weekend_shift": insights.weekend_shift(s, exact), "par_index": insights.par_index(g, None, exact),
                  "load_per_meter": insights.load_per_meter(g, None, exact), "gold_outliers": insights.gold_outliers(g, exact=exact)}
        for name, want in single.items():
            assert_close(reps[name], want)
    # The forms agree to rounding.
    for report, df, key in ((insights.weekend_shift, s, {}), (insights.par_index, g, {"k": None}), (insights.load_per_meter, g, {"k": None})):
        assert_close(report(df, exact="any", **key), report(df, exact=True, **key))
        assert_close(report(df, **key), report(df, exact=True, **key))


def assert_close(got, want):
    got, want = (sorted(map(tuple, df.collect()), key=lambda r: [repr(x)[:12] for x in r]) for df in (got, want))
    assert len(got) == len(want) > 0
    for g, w in zip(got, want):
        for x, y in zip(g, w):
            assert x == y or abs(x - y) <= 1e-9 * max(1.0, abs(y))


def test_reports_do_not_round_readings(spark):
    """Seven decimals: means equal the exact ones, bit for bit and on any partitioning."""
    import math
    import random

    from meterlake.operators import insights
    rng = random.Random(6)
    rows = [(rng.choice("ab"), f"2024-01-{rng.randint(1, 28):02d}", round(rng.random() * 3, 7)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "acorn_group string, d string, consumption double").withColumn(
        "timestamp", F.col("d").cast("timestamp"))
    want = {}
    for g in "ab":
        import datetime as dt
        end = [x for k, d, x in rows if k == g and dt.date.fromisoformat(d).weekday() >= 5]
        day = [x for k, d, x in rows if k == g and dt.date.fromisoformat(d).weekday() < 5]
        want[g] = (math.fsum(day) / len(day), math.fsum(end) / len(end))
    for parts in (1, 9):
        got = insights.weekend_shift(df.repartition(parts), exact="any").collect()
        assert {r["acorn_group"]: (r["avg_weekday"], r["avg_weekend"]) for r in got} == want
    for r in insights.weekend_shift(df).collect():
        assert math.isclose(r["avg_weekday"], want[r["acorn_group"]][0], rel_tol=1e-13)
