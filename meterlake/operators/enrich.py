"""Silver layer: cleaned readings enriched with household group and hourly weather."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions import columns as C
from meterlake.operators.joins import DEFAULT_MAX_BROADCAST_BYTES, dimension_join, settle_all

SILVER_COLUMNS = ["LCLid", "timestamp", "consumption", "acorn_group",
                  "temperature", "apparentTemperature", "humidity", "precipType"]


def enrich_silver(readings: DataFrame, households: DataFrame, weather: DataFrame,
                  max_broadcast_bytes: int | None = DEFAULT_MAX_BROADCAST_BYTES,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """readings (LCLid, timestamp, consumption) -> silver.

    Inner join on the meter (meters without an informative group leave), then
    left join on the truncated hour (hours without weather keep NULL
    weather). Both dimensions are broadcast when their measured size allows,
    so the reading side is never shuffled for enrichment.
    """
    r = readings.withColumn("join_hour", C.hour_key("timestamp"))
    homes, hours = households, weather
    if max_broadcast_bytes is not None:
        homes, hours = settle_all([households, weather])
    r = dimension_join(r, homes, F.col("LCLid") == F.col("meter_id"), "inner", max_broadcast_bytes,
                       dim_key="meter_id")
    r = dimension_join(r, hours, F.col("join_hour") == F.col("weather_hour"), "left", max_broadcast_bytes,
                       dim_key="weather_hour")
    return r.select(*[F.col(c) for c in SILVER_COLUMNS], *[F.col(k) for k in keep])
