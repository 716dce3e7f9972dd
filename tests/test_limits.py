"""Cases beyond the fixture: very many rows, reordered CSV columns, a half-written snapshot."""

from pyspark.sql import functions as F


def test_moments_of_four_billion_rows(spark):
    from meterlake.functions import moments
    n = 4_000_000_000
    row = (spark.createDataFrame([(n, 2 * n, 5 * n)], "n long, s long, q long")
           .select(moments.sd_from(F.col("n"), F.col("s"), F.col("q"), 0).alias("sd")).first())
    assert abs(row["sd"] - 1.0) < 1e-9


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    from meterlake.sources.files import read_readings_csv
    (tmp_path / "block.csv").write_text("tstp,LCLid,energy(kWh/hh)\n2024-01-01 00:00:00,M1,0.5\n")
    row = read_readings_csv(spark, f"{tmp_path}/*.csv").first()
    assert (row["LCLid"], row["tstp"], row["energy(kWh/hh)"]) == ("M1", "2024-01-01 00:00:00", "0.5")


def test_half_written_snapshot_is_not_live(spark, tmp_path):
    from meterlake.streaming.jobs import read_gold
    path = str(tmp_path / "gold")
    assert read_gold(spark, path, "complete").count() == 0
    spark.range(40).write.parquet(f"{path}/snapshot={1:020d}")
    spark.range(10).write.parquet(f"{path}/snapshot={2:020d}")
    (tmp_path / "gold" / f"snapshot={2:020d}" / "_SUCCESS").unlink()
    assert read_gold(spark, path, "complete").count() == 40


def test_compaction_publishes_the_live_snapshot(spark, tmp_path):
    from meterlake.operators.maintenance import compact_live
    from meterlake.streaming.jobs import read_gold
    path = str(tmp_path / "gold")
    assert compact_live(spark, path) is None
    spark.range(40).write.parquet(f"{path}/snapshot={3:020d}")
    spark.range(50).repartition(4).write.parquet(f"{path}/snapshot={7:020d}")
    assert compact_live(spark, path).count() == 50
    live = read_gold(spark, path, "complete")
    assert live.columns == ["id"] and live.count() == 50
    assert all(f"snapshot={8:020d}" in f for f in live.inputFiles()) and len(live.inputFiles()) == 1


def _poisoned(spark):
    rows = [("M1", 10 * i, float(100 + i % 7), 12.0) for i in range(40)] + [
        ("M1", 45, float("nan"), 12.0), ("M1", 46, 1e300, 12.0), ("M1", 47, float("-inf"), 12.0),
        ("M1", 500, 190.0, 12.0), ("M1", 510, 900.0, float("nan"))]
    return spark.createDataFrame(rows, "LCLid string, s long, consumption double, temperature double").selectExpr(
        "LCLid", "timestamp_seconds(1704067200 + s) AS timestamp", "consumption", "temperature")


def test_readings_without_fixed_point_form_leave_no_trace_in_the_detector(spark):
    from meterlake import params as P
    from meterlake.functions import columns as C
    from meterlake.operators.detector import anomaly_alerts
    from meterlake.streaming.detector_state import score_batch
    p = P.DetectorParams(calibration=5)
    rows = _poisoned(spark)
    batch = anomaly_alerts(rows, p).drop("temperature").orderBy("timestamp").collect()
    assert [r["currentValue"] for r in batch] == [190.0, 900.0]
    usable = rows.filter(C.usable_reading("consumption"))
    assert batch == anomaly_alerts(usable, p).drop("temperature").orderBy("timestamp").collect()
    streamed, moments = score_batch("M1", usable.toPandas(), 0, 0, 0, p)
    assert [tuple(r)[2:] for r in streamed.itertuples(index=False)][0][:3] == tuple(batch[0])[2:5]
    assert list(streamed["message"]) == [r["message"] for r in batch]
    assert moments[0] == 42 and moments[1] < 10 ** 7


def test_detector_moments_beyond_64_bits():
    import numpy as np
    from meterlake import params as P
    from meterlake.streaming.detector_state import score_arrays
    x = np.array([9e8, 8e8, 9e8, 1.0])
    out = [score_arrays(np.arange(4), x, np.full(4, 12.0), n0, s0, q0, P.DEFAULT_DETECTOR)[4]
           for n0, s0, q0 in ((0, 0, 0), (4_000_000_000, 4_000_000_000, 10 ** 22))]
    units = [int(v * 10 ** P.DEFAULT_DETECTOR.value_scale) for v in x]
    assert out[0] == (4, sum(units), sum(u * u for u in units))
    assert out[1] == (4_000_000_004, 4_000_000_000 + sum(units), 10 ** 22 + sum(u * u for u in units))


def test_poison_readings_in_gold_and_reports(spark):
    from meterlake.operators import gold, insights
    silver = _poisoned(spark).selectExpr("*", "'A' AS acorn_group", "'rain' AS precipType")
    clean = silver.filter("abs(consumption) <= 1e9")
    keys = ["total_load", "avg_consumption"]
    told = gold.gold_kpis(silver, exact_scale=3).orderBy("window").select(*keys).collect()
    assert told == gold.gold_kpis(clean, exact_scale=3).orderBy("window").select(*keys).collect()
    # the temperatures of such readings are known, so their own moments (ny, sy, qy) keep them
    told, want = (insights.silver_group_moments(x).drop("ny", "sy", "qy").collect() for x in (silver, clean))
    assert told == want


def test_a_grown_dimension_is_measured_anew(spark, tmp_path):
    from meterlake.operators.joins import dimension_join, settle
    path = str(tmp_path / "dim")
    fact = spark.range(10).withColumnRenamed("id", "k")
    spark.range(3).withColumnRenamed("id", "k").write.parquet(path)
    assert dimension_join(fact, spark.read.parquet(path), "k", "inner").count() == 3
    spark.range(3, 8).withColumnRenamed("id", "k").write.mode("append").parquet(path)
    assert dimension_join(fact, spark.read.parquet(path), "k", "inner").count() == 8
    assert settle(spark.read.parquet(path)).rows == 8
