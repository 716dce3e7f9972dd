"""Parsing, cleaning, dimension and replay rules (FIXTURES.md §2)."""

import datetime as dt

from pyspark.sql import functions as F

from meterlake.operators import cleaning, enrich, eda, replay
from meterlake.operators.joins import dimension_join


def test_dirty_energy_is_dropped(spark):
    pay = spark.createDataFrame(
        [("M1", "2024-01-01 00:00:00.0000000", None), ("M1", "2024-01-01 00:30:00.0000000", ""),
         ("M1", "2024-01-01 01:00:00.0000000", "Null"), ("M1", "2024-01-01 01:30:00.0000000", "xNullx"),
         ("M1", "2024-01-01 02:00:00.0000000", "0.219"), ("M1", "bad time", "1.5"),
         ("M1", "2024-01-01 03:00:00.0000000", "abc")],
        "LCLid string, tstp string, energy string")
    got = cleaning.clean_readings(pay).collect()
    assert len(got) == 3
    by_val = {r["consumption"]: r for r in got}
    assert by_val[0.219]["timestamp"] == dt.datetime(2024, 1, 1, 2, 0)
    assert by_val[1.5]["timestamp"] is None            # unparsable time kept as NULL
    assert None in by_val                               # unparsable number kept as NULL


def test_json_messages_parse_and_malformed_drop(spark):
    msgs = spark.createDataFrame(
        [("M1", '{"LCLid":"M1","tstp":"2024-01-01 00:00:00.0000000","energy":"1.25"}'),
         ("M2", "not json"), ("M3", None)], "key string, value string")
    pay = cleaning.parse_messages(msgs)
    assert pay.count() == 3
    assert cleaning.clean_readings(pay).count() == 1


def test_household_dim_dedups_and_filters(spark):
    raw = spark.createDataFrame(
        [("M1", "Affluent"), ("M1", "Affluent"), ("M2", "ACORN-U"), ("M3", "ACORN-"), ("M4", None),
         ("M5", "Comfortable")], "LCLid string, Acorn_grouped string")
    got = sorted(tuple(r) for r in cleaning.household_dim(raw).collect())
    assert got == [("M1", "Affluent"), ("M5", "Comfortable")]


def test_weather_gap_keeps_reading_and_repeated_hour_fans_out(spark):
    readings = spark.createDataFrame(
        [("M1", dt.datetime(2024, 1, 1, 0, 30), 1.0), ("M1", dt.datetime(2024, 1, 1, 1, 30), 2.0)],
        "LCLid string, timestamp timestamp, consumption double")
    house = spark.createDataFrame([("M1", "Affluent")], "meter_id string, acorn_group string")
    wraw = spark.createDataFrame(
        [("2024-01-01 00:00:00", "5.5", "3.5", "0.8", "rain"), ("2024-01-01 00:00:00", "6.5", "4.5", "0.7", None)],
        "time string, temperature string, apparentTemperature string, humidity string, precipType string")
    w = cleaning.weather_dim(wraw)
    silver = enrich.enrich_silver(readings, house, w).collect()
    assert len(silver) == 3                                   # hour 0 fans out to two rows
    assert [r for r in silver if r["consumption"] == 2.0][0]["temperature"] is None
    wd = cleaning.weather_dim(wraw, dedup=True)
    assert enrich.enrich_silver(readings, house, wd).count() == 2


def test_replay_row_rules(spark):
    lines = spark.createDataFrame(
        [(replay.HEADER,), ("MAC1,2024-01-01 00:00:00.0000000,0.5",), ("MAC2,2024-01-01 00:00:00.0000000,",),
         ("MAC3,2024-01-01,1,2",), ("  MAC4 , 2024-01-01 00:00:00.0000000 ,  0.7  ",),
         ("MAC5,2024-01-01 00:00:00.0000000,1.0,",), ("MAC6,2024-01-01 00:00:00.0000000, ",),
         ("MAC7,,1.0",), ("",), (",,,",)], "value string")
    got = {r["key"]: r["value"] for r in replay.replay_messages(lines).collect()}
    assert set(got) == {"MAC1", "MAC4", "MAC5", "MAC6", "MAC7"}
    assert got["MAC1"] == '{"LCLid":"MAC1","tstp":"2024-01-01 00:00:00.0000000","energy":"0.5"}'
    assert got["MAC4"] == '{"LCLid":"MAC4","tstp":"2024-01-01 00:00:00.0000000","energy":"0.7"}'
    assert got["MAC6"].endswith('"energy":""}')              # spaces-only field: kept, then dropped by cleaning


def test_orphans_count_null_ids(spark):
    raw = spark.createDataFrame([("M1", "t", "1"), ("M2", "t", "1"), (None, "t", "1"), ("M2", "t", "2")],
                                "LCLid string, tstp string, `energy(kWh/hh)` string")
    house = spark.createDataFrame([("M1", "A")], "LCLid string, Acorn_grouped string")
    assert eda.orphan_meters(raw, house).first()["orphan_meters"] == 2


def test_dimension_join_broadcasts_only_when_measured_small(spark):
    fact = spark.range(1000).select(F.col("id").alias("k"))
    dim = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    small = dimension_join(fact, dim, "k", "inner")
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString() or \
        "broadcast" in small._jdf.queryExecution().optimizedPlan().toString().lower()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        big = dimension_join(fact, dim, "k", "inner", max_broadcast_bytes=10)
        plan = big._jdf.queryExecution().optimizedPlan().toString().lower()
        assert "broadcast" not in plan
        assert big.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_big_dimension_is_laid_out_by_key_and_not_reshuffled(spark):
    fact = spark.range(2000).select((F.col("id") % 300).alias("k"), F.col("id").alias("v"))
    dim = spark.range(300).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        j = dimension_join(fact, dim, "k", "inner", max_broadcast_bytes=10, dim_key="k")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SelectedBucketsCount: 8 out of 8" in plan, plan
        assert j.count() == 2000
        # The written dimension already has the join's partitioning: the only
        # exchange left is the fact side's.
        assert plan.count("Exchange hashpartitioning") == 1, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
