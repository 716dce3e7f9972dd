"""Detector semantics: the two source unit cases and the edge cases of FIXTURES.md §2.

Every case runs through both forms -- the streaming state function and the
batch window form -- which must agree exactly.
"""

import datetime as dt
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterlake.operators import detector
from meterlake.params import DetectorParams
from meterlake.streaming.detector_state import Detector, make_detector, score_batch

P = DetectorParams()
UNIT = 1000
T0 = dt.datetime(2024, 1, 1)


def moments(mean, m2, n):
    """Fixed-point moments (n, s, q) of a history with the given mean, m2 and count."""
    s = round(mean * n * UNIT)
    q = round((m2 + n * mean * mean) * UNIT * UNIT)
    return n, s, q


def batch(rows):
    return pd.DataFrame(rows, columns=["timestamp", "consumption", "temperature"])


def test_mild_spike_alerts_and_updates_state():
    n, s, q = moments(1.0, 10.0, 1000)
    out, (n1, _, _) = score_batch("MAC000123", batch([(T0, 12.0, 20.0)]), n, s, q, P)
    assert len(out) == 1
    row = out.iloc[0]
    assert "ALERT CRITICO" in row["message"]
    assert row["currentValue"] == 12.0
    assert n1 == 1001
    z = 11.0 / (math.sqrt(10.0 / 999.0) + 0.1)
    assert row["deviation"] == f"Z-Score: {z:.2f}"
    assert row["message"] == f"ALERT CRITICO: Picco anomalo con clima MITE ({z:.1f} sigma)"
    assert row["expectedAvg"] == pytest.approx(1.0)


def test_calibration_blocks_scoring():
    n, s, q = moments(1.0, 1.0, 100)
    out, (n1, _, _) = score_batch("MAC000456", batch([(T0, 50.0, 20.0)]), n, s, q, P)
    assert out.empty and n1 == 101


@pytest.mark.parametrize("n,expect", [(600, 0), (601, 1)])
def test_calibration_gate_is_strict_on_prior_count(n, expect):
    st = moments(1.0, 10.0 * (n - 1) / 999.0, n)
    out, _ = score_batch("M", batch([(T0, 12.0, 20.0)]), *st, P)
    assert len(out) == expect


@pytest.mark.parametrize("temp,ctx", [(6.0, "MITE"), (30.0, "MITE"), (5.9, "FREDDO"), (30.1, "CALDO")])
def test_temperature_limits_are_strict(temp, ctx):
    # sd = 1 exactly; x chosen so that 8 < z < 15: alert only in mild weather.
    st = moments(1.0, 999.0, 1000)
    mid = 1.0 + 10.0 * 1.1
    out, _ = score_batch("M", batch([(T0, mid, temp)]), *st, P)
    assert len(out) == (1 if ctx == "MITE" else 0)
    # z > 15: alert in any weather, with the weather context.
    high = 1.0 + 20.0 * 1.1
    out, _ = score_batch("M", batch([(T0, high, temp)]), *st, P)
    assert len(out) == 1 and f"clima {ctx} (" in out.iloc[0]["message"]


def test_level_gate_is_strict():
    st = moments(0.0, 0.0, 1000)
    out, _ = score_batch("M", batch([(T0, 6.0, 20.0)]), *st, P)
    assert out.empty
    out, _ = score_batch("M", batch([(T0, 6.001, 20.0)]), *st, P)
    assert len(out) == 1


def test_low_side_alerts():
    st = moments(100.0, 999.0, 1000)   # sd 1
    out, _ = score_batch("M", batch([(T0, 10.0, 20.0)]), *st, P)
    assert len(out) == 1


def test_unsorted_micro_batch_is_scored_in_time_order():
    st = moments(1.0, 10.0, 1000)
    rows = [(T0 + dt.timedelta(minutes=30), 1.0, 20.0), (T0, 12.0, 20.0)]
    out, _ = score_batch("M", batch(rows), *st, P)
    # The spike comes first in time, so it is scored against the carried state only.
    assert len(out) == 1 and out.iloc[0]["timestamp"] == pd.Timestamp(T0)
    assert out.iloc[0]["expectedAvg"] == pytest.approx(1.0)


class FakeState:
    def __init__(self, value=None, timed_out=False, now=0):
        self.value, self.hasTimedOut, self.removed, self.timeout = value, timed_out, False, None
        self.now = now

    def getCurrentProcessingTimeMs(self):
        return self.now

    @property
    def exists(self):
        return self.value is not None

    @property
    def get(self):
        return self.value

    def update(self, v):
        self.value = v

    def remove(self):
        self.removed, self.value = True, None

    def setTimeoutDuration(self, ms):
        self.timeout = ms


def test_expired_state_is_removed_without_output():
    st = FakeState((1000, 1_000_000, 1_010_000_000, 0, 0), timed_out=True)
    out = list(make_detector(P)(("M",), iter([]), st))
    assert out == [] and st.removed


def test_state_update_sets_two_hour_timeout():
    st = FakeState()
    list(make_detector(P)(("M",), iter([batch([(T0, 1.0, 20.0)])]), st))
    assert st.value[0] == 1 and st.timeout == 2 * 3600 * 1000


def test_meter_that_comes_back_after_the_timeout_starts_again():
    # No batch ran when the timeout passed (the query was down): the state is there but out of date.
    for now, count in ((7_199_999 + 5, 1001), (7_200_000 + 5, 1)):
        st = FakeState((*moments(1.0, 10.0, 1000), 0, 5), now=now)
        out = list(make_detector(P)(("M",), iter([batch([(T0, 12.0, 20.0)])]), st))
        assert st.value[0] == count and len(out) == (count == 1001)


class FakeValue:
    def __init__(self):
        self.value, self.ttl = None, None

    def get(self):
        return self.value

    def update(self, v):
        self.value = v

    def getValueState(self, name, schema, ttl):
        self.ttl = ttl
        return self


def test_value_state_detector_equals_the_group_state_one():
    rows = [(T0 + dt.timedelta(minutes=i), float(i % 5), 20.0) for i in range(40)] + [(T0 + dt.timedelta(days=1), 50.0, 20.0)]
    p = P.with_(calibration=10)  # the clock stands still
    state, st, host = FakeValue(), FakeState(), Detector(p)
    host.init(state)
    assert state.ttl == 2 * 3600 * 1000
    for part in (rows[:13], rows[13:20], rows[20:]):
        frames = [batch(part[:4]), batch([]).astype({"consumption": float}), batch(part[4:])]
        a = pd.concat([*host.handleInputRows(("M",), iter(frames), None), batch([])])
        b = pd.concat([*make_detector(p)(("M",), iter(frames), st), batch([])])
        assert a.equals(b) and state.value == st.value
    assert state.value[0] == 41 and len(a) == 1
    state.value = None  # expired
    assert list(host.handleInputRows(("M",), iter([batch(rows[-1:])]), None)) == [] and state.value[0] == 1


def test_sum_of_readings_beyond_64_bits_fails_instead_of_wrapping():
    ts, x, temp = T0, 9e8, 20.0
    frame = pd.DataFrame([(ts, x, temp)] * 3, columns=["timestamp", "consumption", "temperature"])
    with pytest.raises(OverflowError):
        score_batch("M", frame, 10 ** 7, 2 ** 63 - 10, 10 ** 30, P)
    _, (_, s, _) = score_batch("M", frame, 10 ** 7, 2 ** 62, 10 ** 30, P)
    assert s == 2 ** 62 + 3 * 9 * 10 ** 11


def _history(meter, values, temp=20.0, start=T0):
    return [(meter, start + dt.timedelta(minutes=30 * i), float(v), temp) for i, v in enumerate(values)]


def test_batch_form_matches_stream_form(spark):
    # 1000 readings with mean 1.0 and m2 10.0, then a spike; plus a NULL-temperature spike.
    vals = [0.9, 1.1] * 500 + [12.0]
    rows = _history("MAC000123", vals) + [("MAC000123", T0 - dt.timedelta(days=1), 99.0, None)]
    df = spark.createDataFrame(rows, "LCLid string, timestamp timestamp, consumption double, temperature double")
    got = detector.anomaly_alerts(df, P).collect()
    assert len(got) == 1
    out, _ = score_batch("MAC000123", batch([r[1:] for r in rows if r[3] is not None]), 0, 0, 0, P)
    assert len(out) == 1
    assert got[0]["deviation"] == out.iloc[0]["deviation"]
    assert got[0]["message"] == out.iloc[0]["message"]
    assert got[0]["expectedAvg"] == out.iloc[0]["expectedAvg"]


def test_chunked_prefix_equals_single_chunk(spark):
    # A hot key split into many chunks must give exactly the one-chunk result.
    import random
    rnd = random.Random(7)
    rows = []
    for k, n in (("hot", 900), ("cold", 40)):
        rows += [(k, T0 + dt.timedelta(seconds=37 * i), round(rnd.uniform(0, 9), 3), rnd.choice([3.0, 20.0, 31.0]))
                 for i in range(n)]
    df = spark.createDataFrame(rows, "LCLid string, timestamp timestamp, consumption double, temperature double")
    p = DetectorParams(calibration=20, z_mild=1.5, z_extreme=2.0, min_level=1.0)
    base = detector.running_baseline(df, p, chunk_rows=10 ** 9).orderBy("LCLid", "timestamp").collect()
    split = detector.running_baseline(df, p, chunk_rows=7).orderBy("LCLid", "timestamp").collect()
    assert base == split
    a1 = sorted(detector.anomaly_alerts(df, p, chunk_rows=10 ** 9).collect())
    a2 = sorted(detector.anomaly_alerts(df, p, chunk_rows=7).collect())
    assert a1 == a2 and len(a1) > 0
    # And against the per-reading loop of the streaming form.
    for key in ("hot", "cold"):
        sub = batch([r[1:] for r in rows if r[0] == key])
        out, _ = score_batch(key, sub, 0, 0, 0, p)
        assert len(out) == sum(1 for r in a1 if r["LCLid"] == key)


def test_running_baseline_matches_population_formulas(spark):
    vals = [1.0, 2.0, 4.0, 8.0]
    df = spark.createDataFrame(_history("M", vals), "LCLid string, timestamp timestamp, consumption double, temperature double")
    got = detector.running_baseline(df, P).orderBy("timestamp").collect()
    assert [r["prior_n"] for r in got] == [0, 1, 2, 3]
    assert got[3]["prior_mean"] == pytest.approx(7 / 3)
    assert got[3]["prior_sd"] == pytest.approx(pd.Series([1.0, 2.0, 4.0]).std())
    assert got[1]["prior_sd"] == 0.0
    assert got[0]["prior_mean"] is None


def test_null_consumption_or_time_is_not_scored(spark):
    rows = _history("M", [1.0] * 5) + [("M", None, 5.0, 20.0), ("M", T0, None, 20.0)]
    df = spark.createDataFrame(rows, "LCLid string, timestamp timestamp, consumption double, temperature double")
    assert detector.running_baseline(df, P).count() == 5
    assert df.filter(F.col("consumption").isNull()).count() == 1


def test_hot_key_is_spread_over_even_ranges(spark):
    # One key holds a third of the rows; each range must stay near chunk_rows, and cold keys lie in one or two.
    n = 30_000
    df = (spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("m"), (F.col("id") % 500).cast("string")))
        .alias("LCLid"),
        (F.col("id") * F.lit(1_000_000)).alias("_us")))
    ranges = detector.time_ranges(df, "LCLid", "_us", chunk_rows=500)
    assert ranges.count() == n and ranges.drop("_range").exceptAll(df).count() == 0
    assert ranges.groupBy("_range").count().agg(F.max("count")).first()[0] <= 1_000
    held = ranges.groupBy("LCLid").agg(F.count_distinct("_range").alias("ranges"))
    assert held.filter("LCLid = 'hot'").first()["ranges"] >= 15
    assert held.filter("LCLid <> 'hot'").agg(F.max("ranges")).first()[0] <= 2
    # one offset for each range border inside a key, whatever the number of keys
    offsets = detector.range_offsets(ranges, "LCLid", {"n": F.count("_us")})
    assert offsets.count() <= 2 * ranges.select("_range").distinct().count()
    assert offsets.filter("LCLid = 'hot'").agg(F.max("n")).first()[0] < 10_000


@pytest.mark.parametrize("at", ["least(id, 1) * 3000000000000000 + id",               # one early outlier
                                "CASE WHEN id < 4900 THEN id ELSE id * 3600000000 END",  # a burst, then a steady rate
                                "id * id * id"])                                      # ever rarer readings
def test_one_key_with_all_rows_splits_evenly(spark, at):
    df = spark.range(5_001).selectExpr("'hot' AS LCLid", f"CAST({at} AS LONG) AS _us")
    sizes = [r["count"] for r in detector.time_ranges(df, "LCLid", "_us", chunk_rows=500).groupBy("_range").count().collect()]
    assert sum(sizes) == 5_001 and max(sizes) <= 1_000 and len(sizes) >= 8


def test_hot_keys_of_different_sizes_and_rows_without_key(spark):
    rows = [(k, T0 + dt.timedelta(seconds=i), round(1 + i % 7 * 0.5, 3), 20.0)
            for k, n in (("big", 400), ("small", 90), (None, 60)) for i in range(n)]
    df = spark.createDataFrame(rows, "LCLid string, timestamp timestamp, consumption double, temperature double")
    one = sorted(map(str, detector.running_baseline(df, P, chunk_rows=10 ** 9).collect()))
    many = sorted(map(str, detector.running_baseline(df, P, chunk_rows=50).collect()))
    assert one == many and len(one) == len(rows)


def test_without_hot_key_nothing_is_written(spark):
    df = spark.range(100).selectExpr("'m' AS LCLid", "id AS _us")
    assert detector.time_ranges(df, "LCLid", "_us", chunk_rows=100) is None
    assert detector.time_ranges(df.limit(0), "LCLid", "_us", chunk_rows=100) is None
