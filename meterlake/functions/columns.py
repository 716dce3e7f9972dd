"""Column expressions shared by the batch and streaming plans.

All of them are built from ``pyspark.sql.functions`` so they stay inside
whole-stage code generation. Parsing uses the ``try_`` forms: Spark runs
with ANSI semantics, where a bad cast or an unparsable timestamp would fail
the job instead of yielding NULL as the readings' dirty rows require.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterlake import params as P


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def energy_present(c) -> Column:
    """True for a usable energy text: not empty and not containing ``Null``.

    A NULL value yields NULL, which a filter treats as false (dropped).
    """
    c = _c(c)
    return (c != F.lit("")) & ~c.contains(P.MISSING_MARKER)


def parse_reading_ts(c, fmt: str = P.READING_TS_FORMAT) -> Column:
    return F.try_to_timestamp(_c(c), F.lit(fmt))


def parse_weather_ts(c, fmt: str = P.WEATHER_TS_FORMAT) -> Column:
    return F.try_to_timestamp(_c(c), F.lit(fmt))


def to_double(c) -> Column:
    return _c(c).try_cast("double")


def usable_reading(c, limit: float = P.MAX_READING) -> Column:
    """True for a number within ``limit`` on either side; false for NaN, infinities and absurd magnitudes.

    Such readings stay in silver but cannot be written in fixed point: the
    detector, the exact indicators and the fixed-point reports leave them out.
    """
    return F.abs(_c(c)) <= F.lit(limit)


def hour_key(c) -> Column:
    """Hour the reading falls in; the equi-key of the weather join."""
    return F.date_trunc("hour", _c(c))


def is_weekend(c) -> Column:
    """1 on Saturday and Sunday, else 0 (``dayofweek``: 1 = Sunday, 7 = Saturday)."""
    return F.when(F.dayofweek(_c(c)).isin(1, 7), F.lit(1)).otherwise(F.lit(0))


def temperature_bin(c, width: float = 5.0) -> Column:
    """Centre of the ``width``-degree bin, ``round(t / width) * width`` (half away from zero)."""
    return F.round(_c(c) / F.lit(width)) * F.lit(width)


def z_threshold(temp, p: P.DetectorParams) -> Column:
    temp = _c(temp)
    # NaN is above every number in Spark; an unknown temperature counts as mild
    extreme = (temp < F.lit(p.cold)) | ((temp > F.lit(p.hot)) & ~F.isnan(temp))
    return F.when(extreme, F.lit(p.z_extreme)).otherwise(F.lit(p.z_mild))


def weather_context(temp, p: P.DetectorParams) -> Column:
    temp = _c(temp)
    return (F.when(temp < F.lit(p.cold), F.lit(P.CONTEXT_COLD))
            .when((temp > F.lit(p.hot)) & ~F.isnan(temp), F.lit(P.CONTEXT_HOT))
            .otherwise(F.lit(P.CONTEXT_MILD)))


def fixed_point_text(c, places: int) -> Column:
    """Text of a non-negative double with ``places`` decimals, rounded half up.

    Rounding is done on the binary value (``floor(x * 10^p + 0.5)``) and the
    digits are assembled from integers, so the text is the same on every
    engine and locale; ``format_string('%.2f')`` would round the shortest
    decimal representation instead and follow the JVM locale.
    """
    c = _c(c)
    scale = 10 ** places
    q = F.floor(c * F.lit(float(scale)) + F.lit(0.5)).cast("long")
    if places == 0:
        return q.cast("string")
    return F.format_string(f"%d.%0{places}d", F.floor(q / F.lit(scale)).cast("long"),
                           F.pmod(q, F.lit(scale)))
