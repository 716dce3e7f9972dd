"""Stream-stream enrichment: readings joined with a weather stream.

Both sides carry a watermark; the join is an equality on the reading's hour
plus a time-range bound (the weather hour lies within the hour before the
reading), which lets Spark drop join state once the watermarks pass it. With
``how="left"`` a reading without weather is emitted, with NULL weather, once
the watermark has passed its bound -- the streaming form of the static left
join of :func:`meterlake.operators.enrich.enrich_silver`.

For a bounded replay, :func:`end_markers` gives one marker row per stream
far in the future: it moves both watermarks past every real row so the last
unmatched readings are emitted. The reading marker has no household, so the
household join drops it after it has advanced the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake import params as P
from meterlake.functions import columns as C
from meterlake.operators import cleaning
from meterlake.operators.enrich import SILVER_COLUMNS
from meterlake.operators.joins import DEFAULT_MAX_BROADCAST_BYTES, dimension_join

END_METER = "~end-of-replay"
END_TIME = "2999-12-31 00:00:00"


def stream_stream_enrich(messages: DataFrame, weather_rows: DataFrame, households: DataFrame,
                         reading_watermark: str = P.WATERMARK, weather_watermark: str = "1 hour",
                         how: str = "left", salts: int = 32,
                         max_broadcast_bytes: int | None = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """messages (key, value) x raw weather rows (text columns) -> silver rows.

    The join's only equality is the hour, and one or two hours are live at a
    time, so readings are spread over ``salts`` parts by meter and each (small)
    weather row is repeated for every part.
    """
    readings = (cleaning.clean_readings(cleaning.parse_messages(messages))
                .withWatermark("timestamp", reading_watermark))
    readings = dimension_join(readings, households, F.col("LCLid") == F.col("meter_id"), "inner",
                              max_broadcast_bytes, dim_key="meter_id")
    r = (readings.withColumn("join_hour", C.hour_key("timestamp"))
         .withColumn("salt", F.pmod(F.xxhash64("LCLid"), F.lit(salts)).cast("int")))
    w = (cleaning.weather_dim(weather_rows)
         .withColumn("weather_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
         .withWatermark("weather_hour", weather_watermark))
    cond = ((r["join_hour"] == w["weather_hour"]) & (r["salt"] == w["weather_salt"])
            & (w["weather_hour"] >= r["timestamp"] - F.expr("INTERVAL 1 HOUR"))
            & (w["weather_hour"] <= r["timestamp"]))
    j = r.join(w, cond, "leftOuter" if how == "left" else "inner")
    return j.select(*SILVER_COLUMNS)


def end_markers(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """(reading message, weather row) that close a bounded replay."""
    tstp = END_TIME + ".0000000"
    msg = spark.createDataFrame(
        [(END_METER, f'{{"LCLid":"{END_METER}","tstp":"{tstp}","energy":"0"}}')], "key string, value string")
    weather = spark.createDataFrame([(END_TIME, None, None, None, None)],
                                    "time string, temperature string, apparentTemperature string, "
                                    "humidity string, precipType string")
    return msg, weather
