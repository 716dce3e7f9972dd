"""Weather-aware running z-score detector, batch form.

For every reading (in time order per key) the score uses the key's history
*before* it: count ``n``, mean and sample standard deviation. A reading is an
alert when ``n > calibration``, ``z = |x - mean| / (sd + 0.1)`` exceeds the
threshold for its temperature (higher in extreme weather) and ``x`` exceeds
the minimum level. Every reading, alert or not, then enters the history.

Exactness. Readings are fixed-point numbers (``value_scale`` decimals), so
the history is kept as integer moments in that unit: ``n``, ``s = sum(xi)``
and ``q = sum(xi^2)``. Then ``mean = s / n`` and
``var = (n*q - s^2) / (n*(n-1))`` with the numerator computed exactly in
decimal, so there is no cancellation and the result does not depend on
how the history is split, summed or ordered across tasks and micro-batches.
The streaming form keeps the same integers as its state.

Scale. A plain per-key window would put one key's whole history into one
task; a key may hold a third of all rows. Where a key has more than ``chunk_rows``
readings ("hot", told by a count that combines before its shuffle) the history is
computed as a parallel scan; without a hot key the plan is one window over
one shuffle of the readings, and stops here. The scan:

1. the readings are range-partitioned by (key, time) and written with the number of their
   range. Spark samples the readings to find the borders, so ranges hold about
   as many readings each however keys and arrivals are spread; only readings of one key with
   the very same time stay together. Writing fixes the borders: a task that
   is repeated finds the same ranges;
2. an ordered window gives the prefix inside each (range, key);
3. totals per (range, key) by a partial aggregate. Only keys that lie in several ranges need
   an offset, the running total of their earlier ranges: at most two
   rows per range border, which are broadcast and added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake import params as P
from meterlake.functions import columns as C
from meterlake.functions.moments import fixed
from meterlake.session import scratch_path

DEFAULT_CHUNK_ROWS = 200_000
_DEC = "decimal(38,0)"


def time_ranges(df: DataFrame, key: str, time: str, chunk_rows: int | None = DEFAULT_CHUNK_ROWS) -> DataFrame | None:
    """``df`` written in ranges of (key, time) of about ``chunk_rows`` rows, with the range in ``_range``; None without a hot key.

    ``chunk_rows=None`` says that no key is hot, as in the cold part of a layer laid out by key.
    """
    if chunk_rows is None:
        return None
    spark = df.sparkSession
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    if (counts["most"] or 0) <= chunk_rows:
        return None
    ranges = max(-(-counts["rows"] // chunk_rows), spark.sparkContext.defaultParallelism)
    path = scratch_path(spark, "time-ranges")
    (df.repartitionByRange(ranges, F.col(key), F.col(time)).withColumn("_range", F.spark_partition_id())
     .write.parquet(path))
    return spark.read.schema(T.StructType([*df.schema.fields, T.StructField("_range", T.IntegerType())])).parquet(path)


def range_offsets(ranges: DataFrame, key: str, sums: dict[str, Column]) -> DataFrame:
    """(``_range``, key, sums over the key's earlier ranges) for keys that lie in several: at most two rows a range border."""
    totals = ranges.groupBy("_range", key).agg(*(c.alias(n) for n, c in sums.items()))
    earlier = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    running = totals.select("_range", key, F.row_number().over(Window.partitionBy(key).orderBy("_range")).alias("_nth"),
                            *(F.sum(n).over(earlier).alias(n) for n in sums))
    return running.filter("_nth > 1").drop("_nth")


def prior_moments(readings: DataFrame, key: str, p: P.DetectorParams,
                  order: tuple[str, ...] = ("timestamp", "consumption", "temperature"),
                  value: str = "consumption", chunk_rows: int | None = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Add ``prior_n``, ``prior_s``, ``prior_q`` (exclusive prefix moments per key, fixed point)."""
    ts = order[0]
    df = readings.withColumn("_xi", fixed(F.col(value), p.value_scale)) \
                 .withColumn("_us", F.unix_micros(F.col(ts)))
    xi = F.col("_xi")
    sq = xi.cast(_DEC) * xi.cast(_DEC)
    sums = (F.count(xi), F.sum(xi), F.sum(sq))

    def prefix(keys: list[str], order_by: list[str]) -> list[Column]:
        before = Window.partitionBy(*keys).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
        return [F.coalesce(c.over(before), F.lit(0).cast(t)) for c, t in zip(sums, ("long", "long", _DEC))]

    names = ("prior_n", "prior_s", "prior_q")
    ranges = time_ranges(df, key, ts, chunk_rows)
    if ranges is None:
        return df.select("*", *(c.alias(n) for c, n in zip(prefix([key], list(order)), names))).drop("_us")

    own = ranges.select("*", *(c.alias(n) for c, n in zip(prefix(["_range", key], list(order)), ("_ln", "_ls", "_lq"))))
    offsets = range_offsets(ranges, key, dict(zip(("_on", "_os", "_oq"), sums)))
    offsets = offsets.withColumnsRenamed({"_range": "_o_range", key: "_o_key"})
    # rows without a key are a history of their own, as in the window
    same = (F.col("_range") == F.col("_o_range")) & F.col(key).eqNullSafe(F.col("_o_key"))
    joined = own.join(F.broadcast(offsets), same, "left")
    total = [(F.coalesce(f"_o{c}", F.lit(0).cast(t)) + F.col(f"_l{c}")).cast(t)
             for c, t in (("n", "long"), ("s", "long"), ("q", _DEC))]
    return (joined.withColumns(dict(zip(names, total)))
            .drop("_on", "_os", "_oq", "_ln", "_ls", "_lq", "_range", "_o_range", "_o_key", "_us"))


def moments_to_stats(n: Column, s: Column, q: Column, scale: int) -> tuple[Column, Column]:
    """(mean, sample sd) as doubles from exact fixed-point moments.

    ``var = (n*q - s^2) / (n*(n-1))``; 0 for fewer than two readings.
    """
    unit = float(10 ** scale)
    mean = F.when(n > 0, s.cast("double") / (n.cast("double") * F.lit(unit)))
    d = n.cast(_DEC) * q.cast(_DEC) - s.cast(_DEC) * s.cast(_DEC)
    var = F.when(n > 1, d.cast("double") / ((n.cast(_DEC) * (n.cast(_DEC) - F.lit(1))).cast("double") * F.lit(unit * unit))) \
           .otherwise(F.lit(0.0))
    return mean, F.sqrt(var)


def running_baseline(readings: DataFrame, p: P.DetectorParams = P.DEFAULT_DETECTOR, key: str = "LCLid",
                     order: tuple[str, ...] = ("timestamp", "consumption", "temperature"),
                     chunk_rows: int | None = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Each scored reading with its prior count, mean and standard deviation."""
    df = _detector_input(readings, key, order)
    df = prior_moments(df, key, p, order, chunk_rows=chunk_rows)
    mean, sd = moments_to_stats(F.col("prior_n"), F.col("prior_s"), F.col("prior_q"), p.value_scale)
    return df.select(F.col(key), F.col("timestamp"), F.col("consumption"), F.col("temperature"),
                     F.col("prior_n"), mean.alias("prior_mean"), sd.alias("prior_sd"))


def _detector_input(readings: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    # Readings with unknown temperature never reach the detector; readings
    # without a time or a usable number cannot be placed or scored.
    return readings.filter(F.col("temperature").isNotNull() & C.usable_reading("consumption")
                           & F.col("timestamp").isNotNull())


def score(df: DataFrame, p: P.DetectorParams, key: str) -> DataFrame:
    """From prior moments to alert rows (``ALERT`` schema)."""
    mean, sd = moments_to_stats(F.col("prior_n"), F.col("prior_s"), F.col("prior_q"), p.value_scale)
    x = F.col("consumption")
    z = F.abs(x - mean) / (sd + F.lit(p.sd_floor))
    scored = df.select(F.col(key).alias("_k"), "timestamp", "consumption", "temperature", "prior_n",
                       mean.alias("_mean"), z.alias("_z"))
    hits = scored.filter((F.col("prior_n") > F.lit(p.calibration))
                         & (F.col("_z") > C.z_threshold("temperature", p))
                         & (F.col("consumption") > F.lit(p.min_level)))
    return hits.select(
        F.col("_k").cast("string").alias("LCLid"),
        F.col("timestamp"),
        F.col("consumption").alias("currentValue"),
        F.col("_mean").alias("expectedAvg"),
        F.concat(F.lit(P.DEVIATION_PREFIX), C.fixed_point_text(F.col("_z"), 2)).alias("deviation"),
        F.col("temperature"),
        F.concat(F.lit(P.MESSAGE_PREFIX), C.weather_context("temperature", p), F.lit(" ("),
                 C.fixed_point_text(F.col("_z"), 1), F.lit(P.MESSAGE_SUFFIX)).alias("message"),
    )


def anomaly_alerts(silver: DataFrame, p: P.DetectorParams = P.DEFAULT_DETECTOR, key: str = "LCLid",
                   order: tuple[str, ...] = ("timestamp", "consumption", "temperature"),
                   chunk_rows: int | None = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Alerts over a whole silver history (batch twin of the streaming detector).

    Equal to the streaming detector when each micro-batch holds later
    readings than the previous one and no key idles past the state timeout
    (the batch form has no expiry).
    """
    cols = [key] + [c for c in dict.fromkeys(("timestamp", "consumption", "temperature") + tuple(order)) if c != key]
    df = _detector_input(silver, key, order).select(*cols)
    return score(prior_moments(df, key, p, order, chunk_rows=chunk_rows), p, key)
