"""Explicit schemas of every layer; nothing is inferred from data."""

from pyspark.sql import types as T

# Raw half-hourly reading file: header row, every field read as text.
RAW_READING = T.StructType([
    T.StructField("LCLid", T.StringType()),
    T.StructField("tstp", T.StringType()),
    T.StructField("energy(kWh/hh)", T.StringType()),
])

# Household information file: only the columns the jobs use.
RAW_HOUSEHOLD = T.StructType([
    T.StructField("LCLid", T.StringType()),
    T.StructField("Acorn_grouped", T.StringType()),
])

# Hourly weather file: only the columns the jobs use.
RAW_WEATHER = T.StructType([
    T.StructField("time", T.StringType()),
    T.StructField("temperature", T.StringType()),
    T.StructField("apparentTemperature", T.StringType()),
    T.StructField("humidity", T.StringType()),
    T.StructField("precipType", T.StringType()),
])

# Wire message: key = meter id, value = JSON payload, both text.
MESSAGE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])

# JSON payload of a message.
PAYLOAD = T.StructType([
    T.StructField("LCLid", T.StringType()),
    T.StructField("tstp", T.StringType()),
    T.StructField("energy", T.StringType()),
])

SILVER = T.StructType([
    T.StructField("LCLid", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("consumption", T.DoubleType()),
    T.StructField("acorn_group", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("apparentTemperature", T.DoubleType()),
    T.StructField("humidity", T.DoubleType()),
    T.StructField("precipType", T.StringType()),
])

GOLD = T.StructType([
    T.StructField("window", T.StructType([
        T.StructField("start", T.TimestampType()),
        T.StructField("end", T.TimestampType()),
    ])),
    T.StructField("acorn_group", T.StringType()),
    T.StructField("precipType", T.StringType()),
    T.StructField("avg_consumption", T.DoubleType()),
    T.StructField("total_load", T.DoubleType()),
    T.StructField("active_meters", T.LongType()),
    T.StructField("avg_temp", T.DoubleType()),
])

# Output of the detector (one row per anomalous reading).
ALERT = T.StructType([
    T.StructField("LCLid", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("currentValue", T.DoubleType()),
    T.StructField("expectedAvg", T.DoubleType()),
    T.StructField("deviation", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("message", T.StringType()),
])

# Per-meter running state of the streaming detector. The moments are kept as
# exact fixed-point integers (count, sum, sum of squares) so that any split of
# the history into micro-batches gives the same scores as the batch form.
# ``q`` exceeds 64 bits on long histories, hence the decimal. ``seen_ms`` is the
# processing time of the last change.
DETECTOR_STATE = T.StructType([
    T.StructField("n", T.LongType()),
    T.StructField("s", T.LongType()),
    T.StructField("q", T.DecimalType(38, 0)),
    T.StructField("last_ts", T.LongType()),
    T.StructField("seen_ms", T.LongType()),
])

NOTIFICATION = T.StructType([
    T.StructField("LCLid", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("message", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("batch_id", T.LongType()),
])
