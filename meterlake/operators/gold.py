"""Gold layer: sliding-window load indicators per social group and precipitation.

Windows are rolled up from *panes*, tumbling intervals of which every window is a
whole number. A reading is aggregated once, into its pane, and only pane rows (a
few per group and half hour) are copied to the windows they lie in. Pane rows are
mergeable: counts, sums (plain, of a fixed scale, or exact pieces of any double) and a HyperLogLog sketch of the
meters, or one row per meter where meters are counted exactly.

Exact counts of distinct meters need no set and no copy of the readings
either. A meter that is present in a pane is new to a window if its last
earlier pane lies before the window. Each pane therefore keeps, for every
place ``j`` it can have in a window, how many of its meters were not seen in the ``j`` panes before it, and
a window's count is the sum of these over its panes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake import params as P
from meterlake.functions import columns as C
from meterlake.functions import exact as X

KEYS = ("acorn_group", "precipType")
_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds(text: str) -> int:
    """Seconds of an interval text such as ``30 minutes``."""
    number, unit = text.split()
    return round(float(number) * _UNITS[unit.rstrip("s").lower()])


def pane_seconds(window: str, slide: str) -> int:
    """The longest interval of which both the window and its slide are whole multiples."""
    return math.gcd(seconds(window), seconds(slide))


def sketch_bits(rsd: float) -> int:
    """Size (base 2 logarithm of the registers) of a HyperLogLog sketch with about this relative error."""
    return min(21, max(4, math.ceil(2 * math.log2(1.04 / rsd))))


def _measures(sums: str | int) -> list[Column]:
    """Mergeable aggregates of a pane: usable readings and their sum, known temperatures and their sum."""
    x, t = F.col("consumption"), F.col("temperature")
    if sums == "plain":
        load = [F.count(x).alias("n"), F.sum(x).alias("load")]
    elif sums == "exact":
        load = [F.count(F.when(C.usable_reading(x), 1)).alias("n"), *X.limb_sums(x, "load")]
    else:
        load = [F.count(F.when(C.usable_reading(x), 1)).alias("n"),
                F.sum(F.when(C.usable_reading(x), x.try_cast(f"decimal(18,{sums})"))).alias("load")]
    heat = X.limb_sums(t, "heat") if sums == "exact" else [F.sum(t).alias("heat")]
    return [*load, F.count(t).alias("n_temp"), *heat]


def _merged(sums: str | int) -> list[Column]:
    add = lambda c: F.sum(c).alias(c)
    if sums == "exact":
        return [add("n"), *X.merged_limbs("load"), add("n_temp"), *X.merged_limbs("heat")]
    return [add(c) for c in ("n", "load", "n_temp", "heat")]


def _indicators(sums: str | int) -> tuple[Column, Column, Column]:
    """(avg_consumption, total_load, avg_temp) of merged measures."""
    exact = sums == "exact"
    load = X.limb_total("load") if exact else F.col("load").cast("double")
    heat = X.limb_total("heat") if exact else F.col("heat")
    return (F.try_divide(load, F.col("n")).alias("avg_consumption"), load.alias("total_load"),
            F.try_divide(heat, F.col("n_temp")).alias("avg_temp"))


def gold_panes(silver: DataFrame, pane: str = P.SLIDE, by_meter: bool = False, sums: str | int = "plain",
               rsd: float = 0.05) -> DataFrame:
    """One row per (pane, group, precipitation) with a sketch of its meters, or per meter as well (``by_meter``).

    ``sums``: ``plain`` doubles, ``exact`` pieces (:mod:`meterlake.functions.exact`), or the
    number of decimals of a fixed-point sum. The same plan runs in batch and on a stream.
    """
    groups = silver.groupBy(F.window("timestamp", pane).alias("pane"), *KEYS, *(["LCLid"] if by_meter else []))
    sketch = [] if by_meter else [F.hll_sketch_agg("LCLid", sketch_bits(rsd)).alias("meters")]
    return groups.agg(*_measures(sums), *sketch)


def _counted(panes: DataFrame, length: int, places: int, sums: str | int) -> DataFrame:
    """Per-meter pane rows -> one row per pane with ``new[j]``: its meters not seen in the ``j`` panes before."""
    at = F.unix_seconds(F.col("pane.start"))
    seen = Window.partitionBy("LCLid", *KEYS).orderBy(at)
    gap = F.coalesce((at - F.lag(at).over(seen)) / F.lit(length), F.lit(float(places + 1)))
    # a null id is no meter
    gap = F.when(F.col("LCLid").isNotNull(), gap)
    rows = panes.withColumn("gap", gap)
    new = [F.count(F.when(F.col("gap") > j, 1)).alias(f"new{j}") for j in range(places)]
    return rows.groupBy("pane", *KEYS).agg(*_merged(sums), *new)


def roll_windows(panes: DataFrame, window: str = P.WINDOW, slide: str = P.SLIDE, by_meter: bool = False,
                 sums: str | int = "plain") -> DataFrame:
    """Gold rows from pane rows of :func:`gold_panes`: every pane is copied to the windows it lies in."""
    length = pane_seconds(window, slide)
    places, step = seconds(window) // length, seconds(slide) // length
    if by_meter:
        panes = _counted(panes, length, places, sums)
    at = F.unix_seconds(F.col("pane.start"))
    # place j of the pane in a window that starts j panes earlier, where a window does start
    starts = F.filter(F.sequence(F.lit(0), F.lit(places - 1)),
                      lambda j: F.pmod(F.floor(at / length) - j, F.lit(step)) == 0)
    rows = panes.withColumn("j", F.explode(starts)).withColumn("start", at - F.col("j") * F.lit(length))
    if by_meter:
        new = F.element_at(F.array(*(F.col(f"new{j}") for j in range(places))), F.col("j").cast("int") + 1)
        meters = F.sum(new)
    else:
        meters = F.hll_sketch_estimate(F.hll_union_agg("meters"))
    merged = rows.groupBy("start", *KEYS).agg(*_merged(sums), meters.alias("active_meters"))
    begin = F.timestamp_seconds("start")
    avg, load, heat = _indicators(sums)
    return merged.select(F.struct(begin.alias("start"), F.timestamp_seconds(F.col("start") + seconds(window)).alias("end")).alias("window"),
                         *KEYS, avg, load, "active_meters", heat)


def window_stream(panes: DataFrame, window: str = P.WINDOW, slide: str = P.SLIDE, by_meter: bool = False,
                  sums: str | int = "plain") -> DataFrame:
    """Streaming gold rows from a stream of closed panes (append mode): windows of panes, counted meter by meter.

    Aggregates are chained, so state holds pane and window rows (one per meter where meters are counted
    exactly), never a set of meters in one row.
    """
    over = F.window("pane", window, slide).alias("window")
    avg, load, heat = _indicators(sums)
    if by_meter:
        each = panes.groupBy(over, *KEYS, "LCLid").agg(*_merged(sums))
        merged = each.groupBy("window", *KEYS).agg(*_merged(sums), F.count("LCLid").alias("active_meters"))
    else:
        merged = panes.groupBy(over, *KEYS).agg(*_merged(sums), F.hll_sketch_estimate(F.hll_union_agg("meters")).alias("active_meters"))
    return merged.select("window", *KEYS, avg, load, "active_meters", heat)


def sums_of(exact_scale: int | str | None) -> str | int:
    return "plain" if exact_scale is None else exact_scale


def gold_kpis(silver: DataFrame, window: str = P.WINDOW, slide: str = P.SLIDE, approx_meters: bool = True,
              exact_scale: int | str | None = None, rsd: float = 0.05) -> DataFrame:
    """Per (sliding window, acorn_group, precipType): mean and total consumption, active meters and mean temperature.

    ``approx_meters`` estimates the meters from HyperLogLog sketches of the panes; ``False`` counts them
    exactly. ``exact_scale``: None for plain double sums, ``"exact"`` for exact sums of any
    double, a number of decimals for fixed-point sums. All aggregates are partial: each
    task combines its rows before the shuffle on the keys.
    """
    pane, sums = f"{pane_seconds(window, slide)} seconds", sums_of(exact_scale)
    panes = gold_panes(silver, pane, not approx_meters, sums, rsd)
    return roll_windows(panes, window, slide, not approx_meters, sums)
