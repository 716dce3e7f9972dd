"""Batch sources: raw CSV files and persisted layer tables.

No reader infers types from the data: CSV columns are bound by header name and
arrive as the text the files hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake import schemas


def read_readings_csv(spark: SparkSession, path_glob: str) -> DataFrame:
    """Half-hourly reading blocks (``.../halfhourly_dataset/*.csv``), text columns bound by header name."""
    df = spark.read.option("header", True).option("inferSchema", False).option("mode", "PERMISSIVE").csv(path_glob)
    return df.select(*[df[f"`{f.name}`"].cast("string").alias(f.name) for f in schemas.RAW_READING])


def read_households_csv(spark: SparkSession, path: str) -> DataFrame:
    # The file carries more columns than the jobs use; ``enforceSchema=false``
    # would match by header name, so read by name and project.
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return df.select(*[df[f.name].cast("string").alias(f.name) for f in schemas.RAW_HOUSEHOLD])


def read_weather_csv(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return df.select(*[df[f.name].cast("string").alias(f.name) for f in schemas.RAW_WEATHER])


def read_text_lines(spark: SparkSession, path_glob: str) -> DataFrame:
    """Raw lines of CSV files, one row per line (column ``value``), for the replay job."""
    return spark.read.text(path_glob)


def read_layer(spark: SparkSession, path: str, fmt: str = "parquet", since: str | None = None,
               until: str | None = None) -> DataFrame:
    """A persisted layer (silver, gold, alerts). ``fmt="delta"`` when the Delta jar is present.

    ``since`` and ``until`` (dates, both included) read only those days of a layer that is
    partitioned by ``day``; the partition column is left out of the result.
    """
    df = spark.read.format(fmt).load(path)
    if "day" not in df.columns:
        if since or until:
            raise ValueError(f"{path} is not partitioned by day")
        return df
    if since:
        df = df.filter(F.col("day") >= F.lit(since).cast("date"))
    if until:
        df = df.filter(F.col("day") <= F.lit(until).cast("date"))
    return df.drop("day")


def utc_day(time) -> Column:
    """The UTC date of a time, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(time) / 86_400).cast("int"))


def _path(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the files or folders that match a glob, from a listing."""
    path, fs = _path(spark, pattern)
    return [f.getPath().getName() for f in fs.globStatus(path) or []]


def exists(spark: SparkSession, path: str) -> bool:
    path, fs = _path(spark, path)
    return fs.exists(path)


def size_of(spark: SparkSession, pattern: str) -> int:
    """Bytes of the files or folders that match a glob."""
    path, fs = _path(spark, pattern)
    return sum(fs.getContentSummary(f.getPath()).getLength() for f in fs.globStatus(path) or [])


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that a job of ours wrote and has replaced."""
    path, fs = _path(spark, path)
    fs.delete(path, True)


def newest_committed(spark: SparkSession, path: str) -> str | None:
    """Folder of the newest snapshot whose write was committed, from a listing of folder names."""
    path, fs = _path(spark, f"{path}/snapshot=*/_SUCCESS")
    names = [f.getPath().getParent().getName() for f in fs.globStatus(path) or []]
    return max(names, key=lambda n: int(n.partition("=")[2])) if names else None
