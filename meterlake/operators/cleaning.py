"""Parsing and cleaning: messages -> readings, raw files -> dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake import params as P
from meterlake import schemas
from meterlake.functions import columns as C


def parse_messages(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Keyed messages -> payload columns ``LCLid, tstp, energy`` (all text).

    The message value may be binary (Kafka) or text; it is cast to text and
    decoded with the fixed payload schema. Malformed JSON gives an all-NULL
    row, which :func:`clean_readings` drops.
    """
    payload = F.from_json(F.col(value_col).cast("string"), schemas.PAYLOAD)
    return messages.select(payload.alias("data")).select("data.*")


def raw_to_payload(raw: DataFrame) -> DataFrame:
    """Raw CSV readings (``energy(kWh/hh)`` header) -> payload column names."""
    return raw.select(F.col("LCLid"), F.col("tstp"), F.col("`energy(kWh/hh)`").alias("energy"))


def clean_readings(payload: DataFrame, ts_format: str = P.READING_TS_FORMAT,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Drop missing energy, parse the timestamp and the reading.

    Output: ``LCLid, timestamp, consumption`` (+ ``keep`` columns). Rows whose
    timestamp or number does not parse are kept with NULL there, as the
    source does.
    """
    return (payload
            .filter(C.energy_present("energy"))
            .select(F.col("LCLid"),
                    C.parse_reading_ts("tstp", ts_format).alias("timestamp"),
                    C.to_double("energy").alias("consumption"),
                    *[F.col(k) for k in keep]))


def household_dim(raw: DataFrame) -> DataFrame:
    """One row per meter with an informative group: ``meter_id, acorn_group``.

    Duplicated meters keep their smallest non-NULL group (a deterministic
    stand-in for keep-any), then groups containing ``ACORN-`` and NULL groups
    are dropped. The dedup is a partial aggregate, so a meter repeated many
    times is combined map-side before the shuffle.
    """
    dedup = raw.groupBy("LCLid").agg(F.min("Acorn_grouped").alias("Acorn_grouped"))
    return (dedup
            .filter(~F.col("Acorn_grouped").contains(P.UNINFORMATIVE_GROUP))
            .select(F.col("LCLid").alias("meter_id"), F.col("Acorn_grouped").alias("acorn_group")))


def weather_dim(raw: DataFrame, ts_format: str = P.WEATHER_TS_FORMAT, dedup: bool = False) -> DataFrame:
    """Hourly weather: ``weather_hour`` timestamp, three measures as double, ``precipType``.

    Not deduplicated by default: a repeated hour fans its readings out, as
    in the source. ``dedup=True`` keeps one row per hour (smallest values).
    """
    w = raw.select(
        C.parse_weather_ts("time", ts_format).alias("weather_hour"),
        C.to_double("temperature").alias("temperature"),
        C.to_double("apparentTemperature").alias("apparentTemperature"),
        C.to_double("humidity").alias("humidity"),
        F.col("precipType"),
    )
    if dedup:
        w = w.groupBy("weather_hour").agg(
            F.min_by(F.struct("temperature", "apparentTemperature", "humidity", "precipType"),
                     F.struct("temperature", "apparentTemperature", "humidity", "precipType")).alias("w")
        ).select("weather_hour", "w.*")
    return w
