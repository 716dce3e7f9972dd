"""Exploratory profile of the raw readings and households.

The source ran six separate scans of the raw blocks; here the scalar
profile (row count, missing values, time extent) is one aggregate pass, and
the grouped profiles are partial aggregates (each task combines before the
shuffle, so a value held by a third of the rows costs one row per task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake import params as P
from meterlake.operators.joins import DEFAULT_MAX_BROADCAST_BYTES, dimension_join, settle

ENERGY = "`energy(kWh/hh)`"

# Cells of the frequency sketch: one count each, a few bytes a task and cell.
SKETCH_CELLS = 1 << 16


def _missing_energy():
    e = F.col(ENERGY)
    return e.isNull() | (e == F.lit("")) | e.contains(P.MISSING_MARKER)


def raw_profile(raw: DataFrame) -> DataFrame:
    """One row: total rows, missing energy / timestamp / id, first and last timestamp text."""
    return raw.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count(F.when(_missing_energy(), F.lit(1))).alias("missing_energy"),
        F.count(F.when(F.col("tstp").isNull(), F.lit(1))).alias("missing_timestamp"),
        F.count(F.when(F.col("LCLid").isNull(), F.lit(1))).alias("missing_lclid"),
        F.min("tstp").alias("first_tstp"),
        F.max("tstp").alias("last_tstp"),
    )


def row_count(raw: DataFrame) -> DataFrame:
    return raw.agg(F.count(F.lit(1)).alias("total_rows"))


def quality_profile(raw: DataFrame) -> DataFrame:
    return raw_profile(raw).select("missing_energy", "missing_timestamp", "missing_lclid")


def time_extent(raw: DataFrame) -> DataFrame:
    return raw_profile(raw).select("first_tstp", "last_tstp")


def heavy_hitters(rows: DataFrame, column: str, k: int, cells: int = SKETCH_CELLS) -> DataFrame:
    """The rows whose value of a text column can be among its ``k`` most frequent ones, ties included.

    A frequency sketch (rows per hash cell) bounds every value's count from
    above. The values of the ``k`` fullest cells are counted exactly; the
    k-th of these counts bounds the k-th largest of all from below, so only
    cells that hold as many rows can hold a value of the top. Nothing is
    approximate: every row of every candidate stays, whatever the data; values
    that are all equally rare are all candidates.

    The sketch is written once, at most ``cells`` rows whatever the input, and
    passes as a checked broadcast. The other passes read one column and
    shuffle candidates only.
    """
    hashed = rows.withColumn("_cell", F.pmod(F.xxhash64(column), F.lit(cells)).cast("int"))
    sketch = settle(hashed.groupBy("_cell").agg(F.count(F.lit(1)).alias("_rows")))
    fullest = sketch._replace(frame=sketch.frame.orderBy(F.desc("_rows"), "_cell").limit(k).select("_cell"))
    counted = (dimension_join(hashed, fullest, "_cell", "left_semi").groupBy(column)
               .agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n")).limit(k))
    # fewer values than k: all of them belong to the top
    least = counted.agg(F.when(F.count(F.lit(1)) == k, F.min("_n")).otherwise(F.lit(0)))
    candidates = sketch._replace(frame=sketch.frame.filter(F.col("_rows") >= least.scalar()).select("_cell"))
    return dimension_join(hashed, candidates, "_cell", "left_semi").drop("_cell")


def top_values(raw: DataFrame, k: int | None = 10) -> DataFrame:
    """The ``k`` most frequent raw energy texts (ties by text, NULL first); all of them without ``k``."""
    values = raw.select(F.col(ENERGY).alias("energy"))
    if k is not None:
        values = heavy_hitters(values, "energy", k)
    ranked = (values.groupBy("energy").agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.desc("count"), F.asc_nulls_first("energy")))
    return ranked if k is None else ranked.limit(k)


def ts_format_profile(raw: DataFrame) -> DataFrame:
    """Histogram of timestamp text lengths (format consistency)."""
    return (raw.groupBy(F.length("tstp").alias("len_tstp")).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc_nulls_first("len_tstp")))


def group_distribution(households_raw: DataFrame) -> DataFrame:
    """Households per group, unfiltered population (uninformative groups included)."""
    return (households_raw.groupBy("Acorn_grouped").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc_nulls_first("Acorn_grouped")))


def orphan_meter_ids(raw: DataFrame, households_raw: DataFrame,
                     max_broadcast_bytes: int | None = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Meter ids of the readings with no household row (a NULL id counts as an orphan)."""
    ids = raw.select("LCLid").distinct()
    return dimension_join(ids, households_raw.select("LCLid"), "LCLid", "left_anti", max_broadcast_bytes)


def orphan_meters(raw: DataFrame, households_raw: DataFrame) -> DataFrame:
    return orphan_meter_ids(raw, households_raw).agg(F.count(F.lit(1)).alias("orphan_meters"))
