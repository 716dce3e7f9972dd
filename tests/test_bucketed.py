"""Layers laid out by meter: no exchange of the readings, hot meters apart, same results."""

import re

import pytest
from pyspark.sql import functions as F

from meterlake.operators import bucketed, detector, insights, joins
from meterlake.plans import layers, queries
from scripts.plans import drop_initial_plans, plan_text

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def silver(spark):
    return layers.silver_layer(spark, SF)


@pytest.fixture()
def shuffled_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _by_meter_exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning\(LCLid", drop_initial_plans(plan_text(df))))


def test_group_rank_shuffles_alerts_only(spark, silver, shuffled_joins):
    laid = layers.silver_by_meter(spark, SF)
    alerts = queries.alerts_layer(spark, SF)
    # plain silver: its partial counts, their totals for the join, the alerts
    assert _by_meter_exchanges(insights.alert_group_rank(alerts, silver)) == 3
    cold = insights.alert_group_rank(alerts, laid.cold)
    assert _by_meter_exchanges(cold) == 1 and "SelectedBucketsCount" in plan_text(cold)


def test_detector_shuffles_nothing(spark):
    laid = layers.silver_by_meter(spark, SF)
    plan = plan_text(detector.anomaly_alerts(laid.cold, queries.METER_PARAMS, chunk_rows=None))
    assert "Exchange" not in plan and plan.count("Window [") == 1


def test_hot_meters_are_apart_and_results_equal(spark, silver):
    per_meter = {r[0]: r[1] for r in silver.groupBy("LCLid").count().collect()}
    limit = sorted(per_meter.values())[len(per_meter) // 2]
    laid = bucketed.by_key(silver, "LCLid", ("timestamp",), hot_rows=limit, buckets=4)
    hot = {r[0] for r in laid.hot.select("LCLid").distinct().collect()}
    assert hot == {m for m, n in per_meter.items() if n > limit} and hot
    assert laid.cold.filter(F.col("LCLid").isin(list(hot))).count() == 0
    both = laid.cold.unionByName(laid.hot)
    assert both.exceptAll(silver).count() == 0 and silver.exceptAll(both).count() == 0

    def job(part, chunk_rows=None):
        return detector.running_baseline(part, queries.METER_PARAMS, chunk_rows=chunk_rows)
    got = bucketed.over_parts(laid, job, chunk_rows=20)
    want = detector.running_baseline(silver, queries.METER_PARAMS)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    alerts = queries.alerts_layer(spark, SF)
    assert (insights.alert_group_rank(alerts, laid).collect() == insights.alert_group_rank(alerts, silver).collect())


def test_rows_without_a_key_and_an_empty_layer(spark):
    rows = spark.createDataFrame([(None, i) for i in range(30)] + [("a", 1), ("b", 2)], "k string, v int")
    laid = bucketed.by_key(rows, "k", hot_rows=10, buckets=2)
    assert laid.hot.count() == 30 and laid.hot.filter("k is not null").count() == 0
    assert sorted(r["k"] for r in laid.cold.collect()) == ["a", "b"]
    laid = bucketed.by_key(rows, "k", hot_rows=100, buckets=2)
    assert laid.hot.count() == 0 and laid.cold.count() == 32
    laid = bucketed.by_key(rows.limit(0), "k", buckets=2)
    assert laid.hot.count() == 0 and laid.cold.count() == 0


def test_large_dimension_is_joined_in_its_buckets(spark, shuffled_joins):
    dim = joins.settle(spark.range(1000).selectExpr("id AS k", "id * 2 AS v"))
    fact = spark.range(50).withColumnRenamed("id", "f")
    joined = joins.dimension_join(fact, dim, F.col("f") == F.col("k"), "inner", max_broadcast_bytes=0, dim_key="k")
    plan = drop_initial_plans(plan_text(joined))
    assert len(re.findall(r"Exchange hashpartitioning\(f", plan)) == 1
    assert "hashpartitioning(k" not in plan and "SelectedBucketsCount" in plan
    assert joined.count() == 50
