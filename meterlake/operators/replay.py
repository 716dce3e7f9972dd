"""Replay of raw reading files as keyed JSON messages.

The source replayed the CSV blocks through one producer process. Here the
same row rules run as a distributed job over the lines of all blocks; the
result is a ``(key, value)`` DataFrame that can be written to Kafka
(``format("kafka")``) or to message files that the streaming jobs read.

Row rules (fixed values):
  * the header line is skipped;
  * a line is split on ``,`` with trailing empty fields dropped (so a row
    whose last field is empty has 2 fields), then every field is trimmed of
    leading/trailing characters up to U+0020;
  * only rows with exactly 3 fields are sent; quotes are not interpreted;
  * key = meter id, value = ``{"LCLid":…,"tstp":…,"energy":…}``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions import columns as C

HEADER = "LCLid,tstp,energy(kWh/hh)"
_EDGE = r"^[\x00-\x20]+|[\x00-\x20]+$"


def split_fields(line) -> F.Column:
    """Fields of a CSV line: split on commas, trailing empty fields dropped, each trimmed."""
    line = F.col(line) if isinstance(line, str) else line
    parts = F.split(F.regexp_replace(line, ",+$", ""), ",", -1)
    return F.transform(parts, lambda x: F.regexp_replace(x, _EDGE, ""))


def replay_messages(lines: DataFrame, header: str = HEADER, line_col: str = "value") -> DataFrame:
    """CSV text lines -> keyed JSON messages ``(key, value)``."""
    f = split_fields(line_col)
    rows = (lines.filter(F.col(line_col) != F.lit(header))
            .select(f.alias("f"))
            .filter(F.size("f") == 3))
    # ``get`` tolerates a missing index: the optimizer may evaluate later
    # predicates on these fields before the size filter.
    f0, f1, f2 = (F.get(F.col("f"), i) for i in range(3))
    payload = F.struct(f0.alias("LCLid"), f1.alias("tstp"), f2.alias("energy"))
    return rows.select(f0.alias("key"), F.to_json(payload).alias("value"))


SLICE_BYTES = 1 << 30
FILES_PER_SLICE = 8


def time_slices(messages: DataFrame, staging: str, slices: int | None = None,
                slice_bytes: int = SLICE_BYTES) -> list[DataFrame]:
    """The messages cut into about equal parts by reading time, oldest first; as many as their bytes ask for.

    Published one after the other, every meter's messages arrive in time order,
    as from a producer that reads its files front to back. The messages are range-partitioned
    by (time, meter), so a part and every file of it is an interval of time and all are of about
    one size: a meter with a third of all messages is spread over the files like any other.
    Files of one part have no order among themselves, so a cap on files per
    micro-batch should take whole parts. Messages without a readable time
    come first. ``staging`` is a new shared folder that holds the parts.
    """
    spark = messages.sparkSession
    us = F.unix_micros(C.parse_reading_ts(F.get_json_object("value", "$.tstp")))
    timed = messages.withColumn("us", us)
    if slices is None:
        held = timed.agg(F.sum(F.octet_length("value"))).first()[0] or 0
        slices = max(1, -(-held // slice_bytes))
    spread = timed.repartitionByRange(slices * FILES_PER_SLICE, F.col("us").asc_nulls_first(), F.col("key"))
    part = F.floor(F.spark_partition_id() / F.lit(FILES_PER_SLICE)).cast("int")
    spread.withColumn("part", part).sortWithinPartitions("part", "us", "key").write.partitionBy("part").parquet(staging)
    staged = spark.read.schema("key string, value string, us long, part int").parquet(staging)
    return [staged.filter(F.col("part") == k).sortWithinPartitions("us", "key").select("key", "value") for k in range(slices)]


def write_messages(messages: DataFrame, path: str | None = None, fmt: str = "parquet",
                   kafka_bootstrap: str | None = None, topic: str | None = None) -> None:
    """Publish replayed messages: to a Kafka topic (needs the Kafka connector)
    or as message files that the streaming jobs read."""
    if kafka_bootstrap:
        (messages.write.format("kafka").option("kafka.bootstrap.servers", kafka_bootstrap)
         .option("topic", topic).save())
    elif path:
        messages.write.mode("append").format(fmt).save(path)
    else:
        raise ValueError("give a path or a Kafka bootstrap server and topic")
