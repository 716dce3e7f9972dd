"""Property tests of the detector state function.

* Splitting a meter's readings into any time-ordered micro-batches gives
  exactly the alerts of one batch (exact fixed-point state).
* The alerts equal those of a plain per-reading Welford loop in doubles,
  except where a score lies within rounding distance of a threshold.
"""

import datetime as dt
import math

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from meterlake.params import DetectorParams
from meterlake.streaming.detector_state import score_batch

T0 = dt.datetime(2024, 1, 1)
P = DetectorParams(calibration=5, z_mild=2.0, z_extreme=3.0, min_level=0.5)

readings = st.lists(
    st.tuples(st.integers(0, 20_000), st.sampled_from([2.0, 6.0, 15.0, 30.0, 31.5])),
    min_size=1, max_size=120)


def frame(rows):
    return pd.DataFrame({"timestamp": [T0 + dt.timedelta(minutes=30 * i) for i in range(len(rows))],
                         "consumption": [v / 1000.0 for v, _ in rows],
                         "temperature": [t for _, t in rows]})


def run_split(df, cuts):
    n = s = q = 0
    outs = []
    bounds = [0, *sorted(set(cuts)), len(df)]
    for a, b in zip(bounds, bounds[1:]):
        if a == b:
            continue
        out, (n, s, q) = score_batch("M", df.iloc[a:b], n, s, q, P)
        outs.append(out)
    return pd.concat(outs, ignore_index=True) if outs else None, (n, s, q)


@settings(max_examples=150, deadline=None)
@given(readings, st.lists(st.integers(0, 120), max_size=8))
def test_any_micro_batch_split_gives_the_same_alerts(rows, cuts):
    df = frame(rows)
    whole, st_whole = run_split(df, [])
    split, st_split = run_split(df, [c for c in cuts if c < len(df)])
    assert st_whole == st_split
    assert whole.reset_index(drop=True).equals(split.reset_index(drop=True))


def welford_alerts(df):
    n, mean, m2 = 0, 0.0, 0.0
    hits, near = [], []
    for ts, x, t in df.itertuples(index=False):
        thr = P.z_extreme if (t < P.cold or t > P.hot) else P.z_mild
        if n > P.calibration:
            sd = math.sqrt(m2 / (n - 1)) if n > 1 else 0.0
            z = abs(x - mean) / (sd + P.sd_floor)
            if abs(z - thr) < 1e-9 * max(1.0, thr):
                near.append(ts)
            if z > thr and x > P.min_level:
                hits.append(ts)
        n += 1
        d = x - mean
        mean += d / n
        m2 += d * (x - mean)
    return hits, near


@settings(max_examples=150, deadline=None)
@given(readings)
def test_matches_the_welford_loop(rows):
    df = frame(rows)
    out, _ = run_split(df, [])
    ours = set(pd.to_datetime(out["timestamp"])) if out is not None and len(out) else set()
    ref, near = welford_alerts(df)
    diff = ours.symmetric_difference(set(pd.to_datetime(ref)))
    assert diff <= set(pd.to_datetime(near))
