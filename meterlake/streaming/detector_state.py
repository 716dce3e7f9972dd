"""Keyed stateful detector for Structured Streaming.

State per meter: exact fixed-point moments ``n, s, q`` (see
:mod:`meterlake.operators.detector`) and the last reading time. Each
micro-batch of a meter is sorted by time, scored against the state carried
in plus the earlier readings of the same batch, and folded into the state.
Scores are computed with the same sequence of double operations as the
batch form, so a stream split into any micro-batches (in time order) yields
exactly the batch result.

A meter's readings of one micro-batch are gathered as three compact arrays (24 bytes a
reading; the admission cap bounds them), never as one pandas frame. Prefix
moments are cumulative sums over numpy arrays, in
64 bits while a bound shows that ``n*q`` and ``s^2`` fit and over Python
integers beyond; a sum of readings beyond 64 bits fails the query, as it does in batch.
pandas is used only to build the rows that alert.

Two hosts of the same step: :class:`Detector` keeps the moments in a value state whose time to live is
the idle timeout (``transformWithStateInPandas``); :func:`make_detector` gets
the state with its rows (``applyInPandasWithState``) and compares the timeout with the clock itself, so that a
meter that comes back after the timeout calibrates again even if no batch ran in between.
"""

from __future__ import annotations

import decimal
import math
import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from meterlake import params as P
from meterlake import schemas

# PySpark's Arrow serializer concatenates empty frames for keys without
# output; pandas warns about a future dtype rule that does not apply here.
warnings.filterwarnings("ignore", category=FutureWarning, module=r"pyspark\.sql\.pandas\.serializers")

ALERT_COLUMNS = ["LCLid", "timestamp", "currentValue", "expectedAvg", "deviation", "temperature", "message"]
_DTYPES = {"LCLid": "object", "timestamp": "datetime64[ns]", "currentValue": "float64",
           "expectedAvg": "float64", "deviation": "object", "temperature": "float64", "message": "object"}


_EMPTY = pd.DataFrame({c: pd.Series(dtype=t) for c, t in _DTYPES.items()})[ALERT_COLUMNS]


def _empty() -> pd.DataFrame:
    # Built once: constructing a typed empty frame costs far more than scoring.
    return _EMPTY


def _text(z: np.ndarray, places: int) -> list[str]:
    scale = 10 ** places
    q = np.floor(z * float(scale) + 0.5).astype(np.int64)
    return [f"{v // scale}.{v % scale:0{places}d}" for v in q.tolist()]


def score_arrays(ts: np.ndarray, x: np.ndarray, temp: np.ndarray, n0: int, s0: int, q0: int,
                 p: P.DetectorParams):
    """Score one key's readings (any order) against moments ``(n0, s0, q0)``.

    Returns ``(order, hit, mean, z, (n, s, q))``: the time order of the
    inputs, which of the ordered readings alert, their prior mean and score,
    and the moments after the batch.
    """
    order = np.lexsort((temp, x, ts))           # by time, then reading, then temperature
    x, temp = x[order], temp[order]
    m = len(x)
    unit = float(10 ** p.value_scale)
    v = x * unit
    xi = (np.sign(v) * np.floor(np.abs(v) + 0.5)).astype(np.int64)  # half away from zero, as Spark's round
    n = n0 + np.arange(m, dtype=np.int64)
    top = int(np.abs(xi).max(initial=0))
    if abs(s0) + m * top >= 2 ** 63 and abs(s0 + sum(xi.tolist())) >= 2 ** 63:
        raise OverflowError("sum of a meter's readings beyond 64 bits")
    s = s0 + (np.cumsum(xi) - xi)               # exclusive prefix sums
    narrow = max((n0 + m) * (q0 + m * top * top), (abs(s0) + m * top) ** 2) < 2 ** 63
    wide = np.int64 if narrow else object        # Python integers where 64 bits may not hold the products
    xw, sw = xi.astype(wide), s.astype(wide)
    square = xw * xw
    q = q0 + (np.cumsum(square) - square)
    d = (n.astype(wide) * q - sw * sw).astype(np.float64)
    acc = q0 + int(square.sum())
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = np.where(n > 0, s.astype(np.float64) / (n.astype(np.float64) * unit), np.nan)
        var = np.where(n > 1, d / (n.astype(np.float64) * (n - 1).astype(np.float64) * (unit * unit)), 0.0)
    z = np.abs(x - mean) / (np.sqrt(var) + p.sd_floor)
    thr = np.where((temp < p.cold) | (temp > p.hot), p.z_extreme, p.z_mild)
    hit = (n > p.calibration) & (z > thr) & (x > p.min_level)
    return order, hit, mean, z, (n0 + m, s0 + int(xi.sum()), acc)


def alert_rows(key: str, ts: np.ndarray, x: np.ndarray, temp: np.ndarray, n0: int, s0: int, q0: int,
               p: P.DetectorParams) -> tuple[pd.DataFrame, tuple[int, int, int]]:
    """The alert rows of one key's readings (any order) against moments ``(n0, s0, q0)``, and the moments after them."""
    order, hit, mean, z, moments = score_arrays(ts, x, temp, n0, s0, q0, p)
    if not hit.any():
        return _empty(), moments
    x, temp, ts = x[order][hit], temp[order][hit], ts[order][hit]
    zh = z[hit]
    ctx = np.where(temp < p.cold, P.CONTEXT_COLD, np.where(temp > p.hot, P.CONTEXT_HOT, P.CONTEXT_MILD))
    out = pd.DataFrame({
        "LCLid": [str(key)] * len(x),
        "timestamp": ts,
        "currentValue": x,
        "expectedAvg": mean[hit],
        "deviation": [P.DEVIATION_PREFIX + t for t in _text(zh, 2)],
        "temperature": temp,
        "message": [f"{P.MESSAGE_PREFIX}{c} ({t}{P.MESSAGE_SUFFIX}" for c, t in zip(ctx, _text(zh, 1))],
    })
    return out, moments


def gathered(frames: Iterator[pd.DataFrame]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(time, reading, temperature) arrays of all frames; each frame is let go before the next is taken."""
    parts = [(f["timestamp"].to_numpy(), f["consumption"].to_numpy(dtype=np.float64),
              f["temperature"].to_numpy(dtype=np.float64)) for f in frames if len(f)]
    if not parts:
        return np.zeros(0, "datetime64[ns]"), np.zeros(0), np.zeros(0)
    return parts[0] if len(parts) == 1 else tuple(np.concatenate(c) for c in zip(*parts))


def score_batch(key: str, pdf: pd.DataFrame, n0: int, s0: int, q0: int,
                p: P.DetectorParams) -> tuple[pd.DataFrame, tuple[int, int, int]]:
    """:func:`alert_rows` of one frame."""
    return alert_rows(key, *gathered(iter([pdf])), n0, s0, q0, p)


def step(key: str, frames: Iterator[pd.DataFrame], value: tuple | None, p: P.DetectorParams,
         now_ms: int = 0) -> tuple[pd.DataFrame, tuple | None]:
    """Alert rows and new state value of one key's micro-batch; ``value`` is None for a meter that (re)starts."""
    ts, x, temp = gathered(frames)
    if not len(ts):
        return _empty(), None
    n0, s0, q0 = (int(v) for v in value[:3]) if value is not None else (0, 0, 0)
    out, (n1, s1, q1) = alert_rows(key, ts, x, temp, n0, s0, q0, p)
    last = ts.max().astype("datetime64[ms]").astype(np.int64)
    return out, (n1, s1, decimal.Decimal(q1), int(last), now_ms)


class Detector(StatefulProcessor):
    """The detector on ``transformWithStateInPandas``: a value state that expires when a meter has been idle."""

    def __init__(self, p: P.DetectorParams):
        self.p = p

    def init(self, handle: StatefulProcessorHandle) -> None:
        ttl = _duration_ms(self.p.timeout) if self.p.timeout else None
        self.moments = handle.getValueState("moments", schemas.DETECTOR_STATE, ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        out, value = step(key[0], rows, self.moments.get(), self.p)  # None once it has expired
        if value is not None:
            self.moments.update(value)
        if len(out):
            yield out

    def close(self) -> None:
        pass


def make_detector(p: P.DetectorParams):
    """The ``applyInPandasWithState`` function for parameters ``p``."""
    timeout_ms = _duration_ms(p.timeout) if p.timeout else None

    def detect(key: tuple, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            # Idle past the timeout: forget the meter; it calibrates again.
            state.remove()
            return
        value = state.get if state.exists else None
        # A key with rows in this batch is not timed out by Spark, even if the timeout passed while the query was down.
        now = state.getCurrentProcessingTimeMs() if timeout_ms else 0
        if value is not None and timeout_ms and now - value[4] >= timeout_ms:
            value = None
        out, value = step(key[0], pdfs, value, p, now)
        if value is None:
            return
        state.update(value)
        if timeout_ms:
            state.setTimeoutDuration(timeout_ms)
        if len(out):
            yield out

    return detect


def _duration_ms(text: str) -> int:
    num, unit = text.split()
    unit = unit.rstrip("s").lower()
    factor = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}[unit]
    return int(math.ceil(float(num) * factor))
