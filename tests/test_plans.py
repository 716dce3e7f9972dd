"""Plan shape guards: the scale properties the README claims, checked on the physical plans."""

import pytest
from pyspark.sql import functions as F

from scripts.plans import drop_initial_plans, plan_text, summary

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plans(spark):
    from __spark_entry__ import queries
    qs = queries()
    return {n: summary(drop_initial_plans(plan_text(qs[n](spark, SF))))
            for n in ("anomaly_alerts", "gold_kpis", "gold_active_meters_approx", "thermal_sensitivity",
                      "volatility_index", "weekend_shift", "alert_group_rank", "orphan_meter_ids", "top_values")}


def test_detector_shuffles_readings_once(plans):
    # No key is hot here: one shuffle, one window.
    assert plans["anomaly_alerts"]["shuffles"] == 1
    assert plans["anomaly_alerts"]["windows"] == 1


def test_ranged_detector_shuffles_written_ranges_once(spark):
    from meterlake.operators import detector
    from meterlake.plans import layers, queries
    silver = layers.silver_layer(spark, SF)
    got = summary(drop_initial_plans(plan_text(detector.anomaly_alerts(silver, queries.METER_PARAMS, chunk_rows=20))))
    # readings by (range, key) for the window; totals and offsets, one row per range and key
    assert got["shuffles"] <= 4
    assert got["broadcasts"] == 1                                # the offsets at the range borders


def test_date_range_reads_only_its_partitions(spark):
    from __spark_entry__ import queries
    plan = plan_text(queries()["volatility_index_in_range"](spark, SF))
    assert "PartitionFilters: [isnotnull(day" in plan and "2024-01-08" in plan


def test_large_dimension_leaves_the_session_settings_alone(spark):
    from meterlake.operators import joins
    dim = joins.settle(spark.range(1000).selectExpr("id AS k", "id * 2 AS v"))
    seen = []
    own, spark.conf.set = spark.conf.set, lambda *a: seen.append(a)
    try:
        parts = joins.laid_out(dim, "k")
    finally:
        spark.conf.set = own
    assert seen == [] and spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert parts.count() == 1000 and spark.range(50).join(parts, F.col("id") == F.col("k")).count() == 50


def test_gold_copies_panes_not_readings(spark):
    from meterlake.operators import gold
    from meterlake.plans import layers
    for approx, shuffles in ((True, 2), (False, 4)):             # pane rows, then windows; exact meters: two more
        plan = drop_initial_plans(plan_text(gold.gold_kpis(layers.silver_layer(spark, SF), approx_meters=approx)))
        assert summary(plan)["shuffles"] == shuffles
        assert "Expand" not in plan and "collect_set" not in plan


def test_aggregates_shuffle_once_per_grouping(plans):
    assert plans["weekend_shift"]["shuffles"] == 1
    for n in ("thermal_sensitivity", "volatility_index"):
        assert plans[n]["shuffles"] <= 2                         # group aggregate + ordering of a few rows


def _columns(schema: str) -> set[str]:
    return {f.split(":")[0] for f in schema[len("struct<"):-1].split(",") if f}


def test_scans_read_only_needed_columns(plans):
    # the sketch's cells, and the readings' one column
    assert plans["top_values"]["scans"] == ["struct<_cell:int,_rows:bigint>", "struct<event_id:bigint,value:double>"]
    # (A cached shared aggregate of the silver reports may also read the timestamp.)
    for s in plans["thermal_sensitivity"]["scans"]:
        assert _columns(s) <= {"consumption", "acorn_group", "temperature", "timestamp"}
    for s in plans["anomaly_alerts"]["scans"]:
        assert _columns(s) <= {"LCLid", "timestamp", "consumption", "temperature"}


def test_small_sides_are_broadcast(plans):
    assert plans["orphan_meter_ids"]["broadcasts"] == 1
