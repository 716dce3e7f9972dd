"""Fixed-point moment aggregates.

Meter readings and weather measures are fixed-point numbers. Summing them as
integers in their unit (``round(x * 10^scale)``) is exact, so count, sum and
sum of squares/products do not depend on the order in which partial
aggregates meet -- the statistic is the same for any partitioning, after a
task retry, and on another engine. Mean, sample standard deviation and
Pearson correlation are then derived with a fixed sequence of double
operations; the cancelling differences (``n*q - s^2``) are taken exactly in
decimal before the conversion to double.

All aggregates here are plain ``sum``/``count`` and combine map-side.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEC = "decimal(38,0)"


def fixed(x, scale: int) -> Column:
    """``x`` in units of ``10^-scale``; NULL for a number without a fixed-point form (NaN, infinities, too large)."""
    x = F.col(x) if isinstance(x, str) else x
    return F.round(x * F.lit(float(10 ** scale))).try_cast("long")


def sum_fixed(x, scale: int) -> Column:
    """Exact sum in units of ``10^-scale`` (long)."""
    return F.sum(fixed(x, scale))


def sum_sq_fixed(x, scale: int) -> Column:
    xi = fixed(x, scale).cast(DEC)
    return F.sum(xi * xi)


def sum_prod_fixed(x, sx: int, y, sy: int) -> Column:
    return F.sum(fixed(x, sx).cast(DEC) * fixed(y, sy).cast(DEC))


def count_both(x, y) -> Column:
    """Rows where both measures are known (pairs used by a correlation)."""
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    return F.count(F.when(x.isNotNull() & y.isNotNull(), F.lit(1)))


def mean_from(n: Column, s: Column, scale: int) -> Column:
    return F.when(n > 0, s.cast("double") / (n.cast("double") * F.lit(float(10 ** scale))))


def centered(n: Column, s: Column, q: Column) -> Column:
    """``n*q - s^2`` exactly (= n^2 * population variance, in squared units)."""
    return n.cast(DEC) * q.cast(DEC) - s.cast(DEC) * s.cast(DEC)


def sd_from(n: Column, s: Column, q: Column, scale: int) -> Column:
    """Sample standard deviation; NULL for fewer than two values (as ``stddev_samp``)."""
    unit2 = float(10 ** (2 * scale))
    var = centered(n, s, q).cast("double") / ((n.cast(DEC) * (n.cast(DEC) - F.lit(1))).cast("double") * F.lit(unit2))
    return F.when(n > 1, F.sqrt(var))


def corr_from(n: Column, sx: Column, sy: Column, qx: Column, qy: Column, qxy: Column) -> Column:
    """Pearson correlation from exact co-moments; NULL when undefined."""
    num = (n.cast(DEC) * qxy.cast(DEC) - sx.cast(DEC) * sy.cast(DEC)).cast("double")
    dx = centered(n, sx, qx).cast("double")
    dy = centered(n, sy, qy).cast("double")
    return F.when((n > 1) & (dx > 0) & (dy > 0), num / F.sqrt(dx * dy))
