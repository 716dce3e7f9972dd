"""Streaming forms: equality with the batch twins, restarts, late data, notifier, state expiry."""

import datetime as dt
import json
import time

import pytest

from pyspark.sql import functions as F

from meterlake import schemas
from meterlake.operators import detector, gold, replay
from meterlake.params import DetectorParams
from meterlake.plans import layers
from meterlake.sources import tables
from meterlake.streaming import jobs
from meterlake.streaming.sources import file_messages

SF = "/root/testdata/sf0.001"
METER = DetectorParams(calibration=30, z_mild=3.0, z_extreme=5.0)


def _messages(spark, sf=SF):
    return replay.replay_messages(tables.csv_lines(tables.readings_raw(spark, sf)))


def _dims(spark, sf=SF):
    return layers.households(spark, sf), layers.weather(spark, sf)


def _run(q, limit=300):
    assert q.awaitTermination(limit), "bounded stream did not finish"
    assert q.exception() is None, q.exception()


def test_alerts_stream_in_two_runs_equals_batch(spark, tmpdir_path):
    msgs = _messages(spark)
    cut = dt.datetime(2024, 1, 15)
    with_ts = msgs.withColumn("_ts", F.try_to_timestamp(F.get_json_object("value", "$.tstp"),
                                                          F.lit("yyyy-MM-dd HH:mm:ss.SSSSSSS")))
    inbox, out, ck = f"{tmpdir_path}/in", f"{tmpdir_path}/alerts", f"{tmpdir_path}/ck"
    h, w = _dims(spark)
    p = METER.with_(timeout=None)
    # Part 1: readings before the cut (and unparsable ones); part 2: the rest, after a restart.
    with_ts.filter(F.col("_ts").isNull() | (F.col("_ts") < F.lit(cut))).drop("_ts").write.parquet(inbox, mode="append")
    _run(jobs.start_alerts(jobs.enriched_stream(file_messages(spark, inbox), h, w), out, ck, p, jobs.BOUNDED))
    with_ts.filter(F.col("_ts") >= F.lit(cut)).drop("_ts").write.parquet(inbox, mode="append")
    _run(jobs.start_alerts(jobs.enriched_stream(file_messages(spark, inbox), h, w), out, ck, p, jobs.BOUNDED))
    got = sorted(tuple(r) for r in spark.read.schema(schemas.ALERT).parquet(out).collect())
    want = sorted(tuple(r) for r in detector.anomaly_alerts(layers.silver(spark, SF), METER).collect())
    assert got == want and len(want) > 0


@pytest.mark.parametrize("host", ["group_state", "value_state"])
def test_pause_beyond_the_timeout_restarts_calibration(spark, host):
    import duckdb

    from meterlake.plans import queries, stream_queries
    con = duckdb.connect()
    for t in ("events", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.01/{t}.parquet')")
    want = sorted(map(repr, con.execute(queries.ORACLE["stream_alerts_expired"]).fetchall()))
    df = layers.to_ntz(stream_queries.stream_alerts_expired_table(spark, "/root/testdata/sf0.01", host))
    got = sorted(repr(tuple(r)) for r in df.collect())
    assert got == want and len(want) > 5


def test_gold_complete_stream_equals_batch(spark, tmpdir_path):
    inbox, out, ck = f"{tmpdir_path}/in", f"{tmpdir_path}/gold", f"{tmpdir_path}/ck"
    _messages(spark).repartition(3).write.parquet(inbox)
    h, w = _dims(spark)
    _run(jobs.start_gold(jobs.enriched_stream(file_messages(spark, inbox, max_files_per_trigger=1), h, w),
                         out, ck, "complete", jobs.BOUNDED, exact_scale=3))
    got = layers.to_ntz(jobs.read_gold(spark, out, "complete")).collect()
    want = layers.to_ntz(gold.gold_kpis(layers.silver(spark, SF), exact_scale=3)).collect()
    key = lambda r: (r["window_start"], r["acorn_group"] or "", r["precipType"] or "")
    assert sorted(got, key=key) == sorted(want, key=key)
    # Several snapshots were written (one per batch); the reader took the newest.
    snaps = spark.read.parquet(out).select("snapshot").distinct().count()
    assert snaps >= 3


def _msg(meter, ts, energy):
    tstp = ts.strftime("%Y-%m-%d %H:%M:%S.%f") + "0"
    return meter, json.dumps({"LCLid": meter, "tstp": tstp, "energy": energy}, separators=(",", ":"))


def _late_data_gold(spark, tmpdir_path, mode):
    inbox, out, ck = f"{tmpdir_path}/in-{mode}", f"{tmpdir_path}/gold-{mode}", f"{tmpdir_path}/ck-{mode}"
    house = spark.createDataFrame([("M1", "Affluent")], "meter_id string, acorn_group string")
    weather = spark.createDataFrame([], "weather_hour timestamp, temperature double, apparentTemperature double, "
                                        "humidity double, precipType string")
    d = dt.datetime(2024, 1, 1)
    batches = [[_msg("M1", d.replace(hour=10), "1.0"), _msg("M1", d.replace(hour=12), "1.0")],
               [_msg("M1", d.replace(hour=22), "1.0")],      # spacer: watermark moves to 21:50
               [_msg("M1", d.replace(hour=23), "1.0")],      # the watermark now applies
               [_msg("M1", d.replace(hour=9), "5.0")]]       # 12 h late
    for b in batches:
        spark.createDataFrame(b, "key string, value string").write.parquet(inbox, mode="append")
        _run(jobs.start_gold(jobs.enriched_stream(file_messages(spark, inbox), house, weather), out, ck, mode,
                             jobs.BOUNDED))
    return jobs.read_gold(spark, out, mode)


def test_late_row_kept_in_complete_dropped_in_append(spark, tmpdir_path):
    comp = _late_data_gold(spark, tmpdir_path, "complete")
    assert comp.filter(F.col("total_load") == 5.0).count() == 2          # both windows of 09:00
    app = _late_data_gold(spark, tmpdir_path, "append")
    assert app.filter(F.col("total_load") == 5.0).count() == 0
    assert app.count() > 0


def test_notifier_skips_empty_batches_and_delivers_once(spark, tmpdir_path):
    alerts_dir, out, ck = f"{tmpdir_path}/alerts", f"{tmpdir_path}/notify", f"{tmpdir_path}/ck"
    a = detector.anomaly_alerts(layers.silver(spark, SF), METER)
    a.limit(2).write.parquet(alerts_dir)
    _run(jobs.start_notify(spark, alerts_dir, out, ck, trigger=jobs.BOUNDED))
    _run(jobs.start_notify(spark, alerts_dir, out, ck, trigger=jobs.BOUNDED))   # nothing new
    n1 = jobs.read_notifications(spark, out)
    assert n1.count() == 2 and n1.select("batch_id").distinct().count() == 1
    a.write.parquet(alerts_dir, mode="append")
    _run(jobs.start_notify(spark, alerts_dir, out, ck, trigger=jobs.BOUNDED))
    n2 = jobs.read_notifications(spark, out)
    assert n2.count() == 2 + a.count()
    assert n2.select("batch_id").distinct().count() == 2
    crit = jobs.notifications(a, min_value=10.0)
    assert set(crit.columns) == {"LCLid", "timestamp", "message", "temperature", "processed_at"}


def _wait_input(q, rows, limit=120):
    t0 = time.time()
    while time.time() - t0 < limit:
        seen = sum(p["numInputRows"] for p in q.recentProgress)
        if seen >= rows:
            return
        time.sleep(0.3)
    raise AssertionError(f"stream saw fewer than {rows} rows")


def test_idle_meter_state_expires_and_calibrates_again(spark, tmpdir_path):
    house = spark.createDataFrame([("M1", "Affluent")], "meter_id string, acorn_group string")
    d = dt.datetime(2024, 1, 1)
    weather = spark.createDataFrame([(d.replace(hour=h), 20.0, 18.0, 0.5, None) for h in range(24)],
                                    "weather_hour timestamp, temperature double, apparentTemperature double, "
                                    "humidity double, precipType string")
    p = DetectorParams(calibration=3, z_mild=3.0, z_extreme=5.0, min_level=1.0, timeout="15 seconds")
    history = [_msg("M1", d.replace(hour=h), v) for h, v in zip(range(6), ["1.0", "1.1", "0.9", "1.0", "1.1", "0.9"])]
    spike = [_msg("M1", d.replace(hour=8), "9.0")]

    def run(idle: bool, tag: str) -> int:
        inbox, out, ck = f"{tmpdir_path}/in-{tag}", f"{tmpdir_path}/a-{tag}", f"{tmpdir_path}/ck-{tag}"
        spark.createDataFrame(history, "key string, value string").write.parquet(inbox)
        q = jobs.start_alerts(jobs.enriched_stream(file_messages(spark, inbox), house, weather), out, ck, p,
                              jobs.Trigger(processing_time="200 milliseconds"))
        try:
            _wait_input(q, len(history))
            time.sleep(20.0 if idle else 0.0)
            spark.createDataFrame(spike, "key string, value string").write.parquet(inbox, mode="append")
            _wait_input(q, len(history) + 1)
            time.sleep(1.0)
        finally:
            q.stop()
        try:
            return spark.read.schema(schemas.ALERT).parquet(out).count()
        except Exception:  # noqa: BLE001
            return 0

    assert run(idle=False, tag="busy") == 1
    assert run(idle=True, tag="idle") == 0


def test_three_layer_queries_from_one_source(spark, tmpdir_path):
    inbox, root = f"{tmpdir_path}/in", f"{tmpdir_path}/service"
    _messages(spark).write.parquet(inbox)
    h, w = _dims(spark)
    qs = jobs.start_layer_queries(spark, file_messages(spark, inbox), h, w, root, METER.with_(timeout=None),
                                  triggers={k: jobs.BOUNDED for k in ("silver", "gold", "alerts")})
    for q in qs.values():
        _run(q)
    silver = layers.silver_layer(spark, SF)
    from meterlake.sources.files import read_layer
    written = read_layer(spark, f"{root}/silver")
    assert written.select(silver.columns).exceptAll(silver).count() == 0 and written.count() == silver.count()
    days = read_layer(spark, f"{root}/silver", since="2024-01-08", until="2024-01-09")
    assert 0 < days.count() == silver.filter("to_date(timestamp) BETWEEN '2024-01-08' AND '2024-01-09'").count()
    assert jobs.read_gold(spark, f"{root}/gold").count() == gold.gold_kpis(silver).count()
    got = sorted(tuple(r) for r in spark.read.schema(schemas.ALERT).parquet(f"{root}/alerts").collect())
    assert got == sorted(tuple(r) for r in detector.anomaly_alerts(silver, METER).collect())


@pytest.mark.parametrize("host", ["group_state", "value_state"])
def test_late_reading_still_reaches_the_detector(spark, tmpdir_path, host):
    # With a processing-time timeout the watermark does not filter the detector's input (r10).
    house = spark.createDataFrame([("M1", "Affluent")], "meter_id string, acorn_group string")
    d = dt.datetime(2024, 1, 1)
    weather = spark.createDataFrame([(d.replace(hour=h), 20.0, 18.0, 0.5, None) for h in range(24)],
                                    "weather_hour timestamp, temperature double, apparentTemperature double, "
                                    "humidity double, precipType string")
    p = DetectorParams(calibration=3, z_mild=3.0, z_extreme=5.0, min_level=1.0, timeout=None)
    inbox, out, ck = f"{tmpdir_path}/in", f"{tmpdir_path}/a", f"{tmpdir_path}/ck"
    batches = [[_msg("M1", d.replace(hour=h), v) for h, v in zip(range(10, 16), ["1.0", "1.1", "0.9"] * 2)],
               [_msg("M1", d.replace(hour=23), "1.0")],
               [_msg("M1", d.replace(hour=22), "1.0")],
               [_msg("M1", d.replace(hour=2), "9.0")]]          # 21 h behind the watermark
    for b in batches:
        spark.createDataFrame(b, "key string, value string").write.parquet(inbox, mode="append")
        _run(jobs.start_alerts(jobs.enriched_stream(file_messages(spark, inbox), house, weather), out, ck, p,
                               jobs.BOUNDED, host=host))
    got = spark.read.schema(schemas.ALERT).parquet(out).collect()
    assert len(got) == 1 and got[0]["currentValue"] == 9.0


def test_stream_static_join_with_dimensions_over_the_broadcast_budget(spark, tmpdir_path):
    inbox, out, ck = f"{tmpdir_path}/in", f"{tmpdir_path}/silver", f"{tmpdir_path}/ck"
    _messages(spark).write.parquet(inbox)
    h, w = _dims(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        silver = jobs.enriched_stream(file_messages(spark, inbox), h, w, max_broadcast_bytes=10)
        _run(jobs.start_silver(silver, out, ck, jobs.BOUNDED))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = spark.read.schema(schemas.SILVER).parquet(out)
    want = layers.silver_layer(spark, SF)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
