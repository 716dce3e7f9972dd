"""Streaming sources: keyed reading messages and append-only layer tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake import params as P
from meterlake import schemas


def kafka_messages(spark: SparkSession, bootstrap: str, topic: str,
                   max_per_trigger: int | None = P.MAX_RECORDS_PER_TRIGGER,
                   starting: str = "earliest") -> DataFrame:
    """Reading messages from a Kafka topic (needs the Kafka connector on the classpath)."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic)
         .option("startingOffsets", starting))
    if max_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_per_trigger)
    return r.load().select(F.col("key").cast("string").alias("key"), F.col("value"))


def file_messages(spark: SparkSession, path: str, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Reading messages ``(key, value)`` from files landing in ``path``.

    The offline stand-in for the topic; ``max_files_per_trigger`` is the
    admission cap (files per micro-batch).
    """
    r = spark.readStream.schema(schemas.MESSAGE).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def table_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """New rows of an append-only table (e.g. the alert history), as a stream."""
    return spark.readStream.schema(schema).format(fmt).load(path)
