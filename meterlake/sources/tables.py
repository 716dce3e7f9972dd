"""Adapter from the shared test tables to the pipeline's raw inputs.

The test tables carry no meter data, so readings, households and weather are
derived from ``events`` and ``customer`` by fixed rules (the same rules the
DuckDB oracle uses):

  readings   one per event: meter ``'MAC' || lpad(user_id, 6, '0')``,
             timestamp text with 7 fraction digits (6 from ``ts`` plus ``0``),
             energy text chosen by ``event_id % 50``: 0 -> ``Null``,
             1 -> empty, 2 -> NULL, else ``value`` as text.
  households one per customer, group ``ACORN-U`` for the MACHINERY segment
             else the segment; customers with ``c_custkey % 37 = 5`` are left
             out (their meters become orphans).
  weather    one row per hour of ``ts``: ``k`` (from ``props``) of the hour's
             lowest ``event_id``; temperature ``k*0.5 - 5``, apparent
             temperature 2 degrees lower, humidity ``k/100``, precipitation
             ``rain``/``snow``/NULL for ``k % 3`` = 0/1/2; hours with
             ``k % 10 = 7`` are left out (left-join misses).

Everything is a DataFrame over the scanned parquet, so the derived inputs
grow with the tables and keep their partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.session import app_key


_tables: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table; the (lazy) DataFrame is reused within the session so its
    file listing and footer schema are read once."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (app_key(spark), id(spark), path)
    df = _tables.get(key)
    if df is None:
        df = _tables[key] = spark.read.parquet(path)
    return df


def meter_id(c) -> F.Column:
    return F.concat(F.lit("MAC"), F.lpad(c.cast("string"), 6, "0"))


def readings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw readings as the CSV blocks hold them, plus ``event_id``/``event_type`` carried along."""
    ev = table(spark, sf_dir, "events")
    slot = F.pmod(F.col("event_id"), F.lit(50))
    energy = (F.when(slot == 0, F.lit("Null"))
              .when(slot == 1, F.lit(""))
              .when(slot == 2, F.lit(None).cast("string"))
              .otherwise(F.col("value").cast("string")))
    return ev.select(
        meter_id(F.col("user_id")).alias("LCLid"),
        F.concat(F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("0")).alias("tstp"),
        energy.alias("energy(kWh/hh)"),
        F.col("event_id"),
        F.col("event_type"),
    )


def households_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = table(spark, sf_dir, "customer")
    grp = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("ACORN-U")).otherwise(F.col("c_mktsegment"))
    return (cu.filter(F.pmod(F.col("c_custkey"), F.lit(37)) != 5)
            .select(meter_id(F.col("c_custkey")).alias("LCLid"), grp.alias("Acorn_grouped")))


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather with every field as text, like the weather CSV."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    hourly = (ev.select(F.date_trunc("hour", F.col("ts")).alias("hour"), F.col("event_id"), k.alias("k"))
              .groupBy("hour").agg(F.min_by("k", "event_id").alias("k"))
              .filter(F.pmod(F.col("k"), F.lit(10)) != 7))
    temp = F.col("k").cast("double") * F.lit(0.5) - F.lit(5.0)
    precip = (F.when(F.pmod(F.col("k"), F.lit(3)) == 0, F.lit("rain"))
              .when(F.pmod(F.col("k"), F.lit(3)) == 1, F.lit("snow")))
    return hourly.select(
        F.date_format(F.col("hour"), "yyyy-MM-dd HH:mm:ss").alias("time"),
        temp.cast("string").alias("temperature"),
        (temp - F.lit(2.0)).cast("string").alias("apparentTemperature"),
        (F.col("k").cast("double") / F.lit(100.0)).cast("string").alias("humidity"),
        precip.alias("precipType"),
    )


def csv_lines(readings: DataFrame, header: str = "LCLid,tstp,energy(kWh/hh)") -> DataFrame:
    """Render raw readings as CSV text lines (``value``), one header line per source partition.

    NULL and empty energy both render as an empty trailing field, as in the
    source files.
    """
    line = F.concat_ws(",", F.col("LCLid"), F.col("tstp"), F.coalesce(F.col("`energy(kWh/hh)`"), F.lit("")))
    body = readings.select(line.alias("value"))
    spark = readings.sparkSession
    return spark.createDataFrame([(header,)], "value string").unionByName(body)
