"""Messages published in time order: even files whatever the meters, order kept across parts."""

import datetime as dt

from pyspark.sql import functions as F

from meterlake.operators import replay

T0 = dt.datetime(2024, 1, 1)


def _messages(spark, rows):
    lines = [(f"{k},{t},{e}",) for k, t, e in rows]
    return replay.replay_messages(spark.createDataFrame(lines, "value string").repartition(6))


def _text(minutes):
    return (T0 + dt.timedelta(minutes=minutes)).strftime("%Y-%m-%d %H:%M:%S.%f") + "0"


def test_hot_meter_is_spread_and_time_order_kept(spark, tmpdir_path):
    rows = [("hot", _text(i), str(i % 7)) for i in range(6000)] + [(f"m{i % 60}", _text(i // 2), "1") for i in range(12_000)]
    rows += [("late", "no time", "2"), ("late", "", "3")]
    parts = replay.time_slices(_messages(spark, rows), f"{tmpdir_path}/staged", 4)
    got, last = [], {}
    for k, part in enumerate(parts):
        out = f"{tmpdir_path}/out-{k}"
        replay.write_messages(part, out)
        part = spark.read.parquet(out).select(F.get_json_object("value", "$.LCLid").alias("k"),
                                              F.get_json_object("value", "$.tstp").alias("t"),
                                              F.input_file_name().alias("f")).collect()
        assert 0.6 * len(rows) / 4 < len(part) < 1.4 * len(rows) / 4
        for meter in {r["k"] for r in part} - {"late"}:
            times = [r["t"] for r in part if r["k"] == meter]
            assert min(times) >= last.get(meter, "")
            last[meter] = max(times)
        got += [(r["k"], r["t"]) for r in part]
    assert sorted(got) == sorted((k, t) for k, t, _ in rows)
    assert {k for k, t in got[:len(got) // 4] if k == "late"}  # without a readable time: first
    staged = spark.read.parquet(f"{tmpdir_path}/staged").groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in staged) <= 2 * len(rows) / (4 * replay.FILES_PER_SLICE)


def test_slice_count_follows_the_bytes(spark, tmpdir_path):
    rows = [(f"m{i % 9}", _text(i), "1") for i in range(2000)]
    msgs = _messages(spark, rows)
    held = msgs.agg(F.sum(F.octet_length("value"))).first()[0]
    assert len(replay.time_slices(msgs, f"{tmpdir_path}/a")) == 1
    parts = replay.time_slices(msgs, f"{tmpdir_path}/b", slice_bytes=held // 5)
    assert len(parts) in (5, 6) and sum(p.count() for p in parts) == 2000
    assert [p.count() for p in replay.time_slices(msgs.limit(0), f"{tmpdir_path}/c")] == [0]
