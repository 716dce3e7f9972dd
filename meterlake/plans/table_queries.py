"""Maintenance queries over layers written to the shared scratch folder.

``compact_layer``: silver is written as many small files (as a streaming
sink leaves it), compacted into a new folder, and read back -- the rows must
be exactly the silver rows.

``expired_files``: a gold table gets two snapshots and a third one without its
commit mark; with zero retention the expired files are exactly the files of the
oldest, so the rows they hold must be the gold rows once (a live file listed, or an old one
missed, would change the result).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.operators import cleaning, eda, enrich, maintenance
from meterlake.plans import layers
from meterlake.plans import oracle as O
from meterlake.plans.queries import register
from meterlake.session import scratch_path
from meterlake.sources import files, tables

SMALL_FILE_ROWS = 2_000


@register("compact_layer", O.sql("SELECT * FROM silver", "silver"))
def q_compact_layer(spark: SparkSession, sf: str) -> DataFrame:
    src, dst = scratch_path(spark, "silver-small"), scratch_path(spark, "silver-compact")
    layers.silver_layer(spark, sf).write.option("maxRecordsPerFile", SMALL_FILE_ROWS).mode("overwrite").parquet(src)
    return layers.to_ntz(maintenance.compact(spark, src, dst))


@register("expired_files", O.sql("SELECT * FROM gold", "gold"))
def q_expired_files(spark: SparkSession, sf: str) -> DataFrame:
    table = scratch_path(spark, "gold-table")
    g = layers.gold_layer(spark, sf)
    g.write.mode("overwrite").parquet(f"{table}/snapshot=1")
    g.write.mode("overwrite").parquet(f"{table}/snapshot=2")
    g.write.mode("overwrite").parquet(f"{table}/snapshot=3")
    files.remove(spark, f"{table}/snapshot=3/_SUCCESS")
    expired = maintenance.expired_files(spark, table, retention_hours=0.0, now_ms=int(time.time() * 1000) + 1)
    # Rows of the expired files: every row of the table tagged with its file,
    # semi-joined with the expired list (no file list goes through the driver).
    rows = spark.read.schema(g.schema).parquet(table).withColumn("path", F.col("_metadata.file_path"))
    old = rows.join(expired.select("path"), "path", "left_semi").drop("path", "snapshot")
    return layers.to_ntz(old)


@register("csv_silver", O.sql("SELECT * FROM silver", "silver"))
def q_csv_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Silver rebuilt from CSV files: the raw inputs are written as CSV blocks
    (header row, text fields) and read back with the file sources, as the
    source reads its block files, household file and weather file."""
    root = scratch_path(spark, "csv")
    tables.readings_raw(spark, sf).select("LCLid", "tstp", "`energy(kWh/hh)`") \
        .write.option("header", True).mode("overwrite").csv(f"{root}/halfhourly_dataset")
    tables.households_raw(spark, sf).write.option("header", True).mode("overwrite").csv(f"{root}/households")
    tables.weather_raw(spark, sf).write.option("header", True).mode("overwrite").csv(f"{root}/weather")
    raw = files.read_readings_csv(spark, f"{root}/halfhourly_dataset/*.csv")
    readings = cleaning.clean_readings(cleaning.raw_to_payload(raw))
    house = cleaning.household_dim(files.read_households_csv(spark, f"{root}/households"))
    weather = cleaning.weather_dim(files.read_weather_csv(spark, f"{root}/weather"))
    return layers.to_ntz(enrich.enrich_silver(readings, house, weather))


@register("csv_raw_profile", O.sql("""SELECT count(*) AS total_rows,
       count(CASE WHEN "energy(kWh/hh)" IS NULL OR "energy(kWh/hh)" = '' OR contains("energy(kWh/hh)", 'Null')
                  THEN 1 END) AS missing_energy,
       count(CASE WHEN tstp IS NULL THEN 1 END) AS missing_timestamp,
       count(CASE WHEN LCLid IS NULL THEN 1 END) AS missing_lclid,
       min(tstp) AS first_tstp, max(tstp) AS last_tstp FROM readings_raw""", "readings_raw"))
def q_csv_raw_profile(spark: SparkSession, sf: str) -> DataFrame:
    """The exploratory profile over CSV blocks read by glob (NULL and empty energy both survive the files)."""
    root = scratch_path(spark, "csv-blocks")
    tables.readings_raw(spark, sf).select("LCLid", "tstp", "`energy(kWh/hh)`") \
        .write.option("header", True).mode("overwrite").csv(root)
    return eda.raw_profile(files.read_readings_csv(spark, f"{root}/*.csv"))
