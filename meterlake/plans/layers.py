"""Layer plans over the shared test tables.

``silver``/``gold``/``alerts`` build the medallion layers from the adapter
inputs (see :mod:`meterlake.sources.tables`) with the same operators a
deployment runs over its files and streams.

``*_layer`` functions return the *persisted* layer: built once per session
and data folder, written as parquet under the shared scratch folder
(``spark.checkpoint.dir``) and read back, as the reports of a deployment read
the tables the pipeline wrote. Reading a written table also cuts the lineage,
so a lost executor costs a re-read of files, not a recomputation of joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.operators import bucketed, cleaning, detector, enrich, gold
from meterlake.params import DetectorParams
from meterlake.session import app_key, scratch_path
from meterlake.sources import files, tables

# Decimal places of a reading (kWh per half hour is reported in Wh steps).
VALUE_SCALE = 3


def households(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.household_dim(tables.households_raw(spark, sf_dir))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.weather_dim(tables.weather_raw(spark, sf_dir))


def readings(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    payload = tables.readings_raw(spark, sf_dir).select(
        "LCLid", "tstp", F.col("`energy(kWh/hh)`").alias("energy"), *keep)
    return cleaning.clean_readings(payload, keep=keep)


def silver(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return enrich.enrich_silver(readings(spark, sf_dir, keep), households(spark, sf_dir),
                                weather(spark, sf_dir), keep=keep)


_written: dict[tuple, str] = {}


def materialize(spark: SparkSession, name: str, sf_dir: str, build) -> DataFrame:
    """The table ``build()`` computes, written once per session under the shared folder."""
    key = (app_key(spark), name, sf_dir.rstrip("/"))
    path = _written.get(key)
    if path is None:
        path = scratch_path(spark, f"layer-{name}")
        build().write.mode("overwrite").parquet(path)
        _written[key] = path
    return files.read_layer(spark, path)


def _silver_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The persisted silver also carries the adapter's event type, used to key
    # the detector by type; silver readers prune it away.
    return materialize(spark, "silver", sf_dir, lambda: silver(spark, sf_dir, keep=("event_type",)))


def silver_layer(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return _silver_typed(spark, sf_dir).select(*enrich.SILVER_COLUMNS, *keep)


def silver_days(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the silver layer partitioned by day, as the streaming job writes it, each file sorted by meter."""
    key = (app_key(spark), "silver-days", sf_dir.rstrip("/"))
    if key not in _written:
        path = scratch_path(spark, "layer-silver-days")
        (silver_layer(spark, sf_dir).withColumn("day", files.utc_day("timestamp"))
         .repartition("day").sortWithinPartitions("day", "LCLid", "timestamp").write.partitionBy("day").parquet(path))
        _written[key] = path
    return _written[key]


_laid_out: dict[tuple, bucketed.ByKey] = {}


def silver_by_meter(spark: SparkSession, sf_dir: str) -> bucketed.ByKey:
    """The silver layer laid out by meter, written once per session."""
    key = (app_key(spark), sf_dir.rstrip("/"))
    if key not in _laid_out:
        _laid_out[key] = bucketed.by_key(silver_layer(spark, sf_dir), "LCLid", ("timestamp",))
    return _laid_out[key]


def gold_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold over the persisted silver, with exact meter counts and fixed-point sums (order independent)."""
    return gold.gold_kpis(silver_layer(spark, sf_dir), approx_meters=False, exact_scale=VALUE_SCALE)


def gold_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(spark, "gold", sf_dir, lambda: gold_exact(spark, sf_dir))


def alerts(spark: SparkSession, sf_dir: str, p: DetectorParams, key: str = "LCLid") -> DataFrame:
    s = silver_layer(spark, sf_dir, keep=("event_type",) if key == "event_type" else ())
    return detector.anomaly_alerts(s, p, key=key)


def alerts_layer(spark: SparkSession, sf_dir: str, p: DetectorParams) -> DataFrame:
    tag = f"alerts-{p.calibration}-{p.z_mild}-{p.z_extreme}-{p.min_level}"
    return materialize(spark, tag, sf_dir, lambda: alerts(spark, sf_dir, p))


def to_ntz(df: DataFrame) -> DataFrame:
    """Cast timestamp columns to ``timestamp_ntz`` (UTC wall clock) and flatten window structs.

    Output form only: the layers keep zone-aware timestamps, which watermarks
    require; query results are compared with engines that have naive ones.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name))
        elif isinstance(f.dataType, T.StructType) and f.name == "window":
            cols.append(F.col("window.start").cast("timestamp_ntz").alias("window_start"))
            cols.append(F.col("window.end").cast("timestamp_ntz").alias("window_end"))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)
