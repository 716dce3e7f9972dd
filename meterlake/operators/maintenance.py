"""Layer maintenance as data jobs: compaction and retention.

Layers are folders of parquet files. A table that is rewritten keeps its
versions as sibling snapshot folders (``<table>/snapshot=<n>``, as the gold
stream writes them); the newest snapshot is the live one.

* :func:`compact` rewrites a layer into files of about ``target_bytes``
  into a *new* folder (a stream sink's folder is read through its metadata
  log, so it is never rewritten in place). The file reader already packs
  small files into splits of ``maxPartitionBytes``; ``coalesce`` caps the
  number of output files without a shuffle.
* :func:`expired_files` lists, as a DataFrame, the files of a table that the
  live (newest) snapshot does not hold and that are older than the
  retention. One listing of file metadata; no data file is opened. Deletion
  is a separate, explicit step (:func:`delete_files`), run on the executors.
"""

from __future__ import annotations

import math
import time

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake import params as P
from meterlake.session import ship_package
from meterlake.sources.files import newest_committed

DEFAULT_TARGET_BYTES = 128 * 1024 * 1024


def list_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """``path, modificationTime, length`` of every data file under ``path`` (recursive, metadata only)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", pattern).load(path)
            .select("path", "modificationTime", "length"))


def layer_bytes(spark: SparkSession, path: str) -> int:
    row = list_files(spark, path).agg(F.sum("length").alias("b")).first()
    return int(row["b"] or 0)


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-insensitive content fingerprint: row count and sum of row hashes."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.sum(h.cast("decimal(38,0)")).cast("string").alias("row_hash"))


def compact(spark: SparkSession, src: str, dst: str, target_bytes: int = DEFAULT_TARGET_BYTES,
            fmt: str = "parquet") -> DataFrame:
    """Rewrite the layer at ``src`` into about ``bytes / target_bytes`` files at ``dst``; returns the new layer."""
    n = max(1, math.ceil(layer_bytes(spark, src) / target_bytes))
    spark.read.format(fmt).load(src).coalesce(n).write.mode("overwrite").format(fmt).save(dst)
    return spark.read.format(fmt).load(dst)


def compact_live(spark: SparkSession, table: str, target_bytes: int = DEFAULT_TARGET_BYTES,
                 fmt: str = "parquet") -> DataFrame | None:
    """Publish the live snapshot of ``table`` again as the next snapshot, in files of about ``target_bytes``.

    Readers see the old snapshot until the new one is committed; superseded
    ones are left to the retention. Run it while the table's writer is
    stopped: a snapshot that already exists is never overwritten. None if the
    table has no committed snapshot.
    """
    live = newest_committed(spark, table)
    if live is None:
        return None
    number = int(live.partition("=")[2]) + 1
    src, dst = f"{table}/{live}", f"{table}/snapshot={number:020d}"
    n = max(1, math.ceil(layer_bytes(spark, src) / target_bytes))
    spark.read.format(fmt).load(src).coalesce(n).write.mode("errorifexists").format(fmt).save(dst)
    return spark.read.format(fmt).load(dst)


def snapshot_files(spark: SparkSession, table: str) -> DataFrame:
    """Data files of a snapshot table with their snapshot number (from the ``snapshot=<n>`` folder)."""
    snap = F.regexp_extract(F.col("path"), r"/snapshot=(\d+)/", 1)
    return (list_files(spark, table)
            .withColumn("snapshot", F.when(snap != "", snap.cast("long"))))


def live_number(spark: SparkSession, table: str) -> int | None:
    """Number of the live snapshot: the newest one whose write was committed, as readers take it."""
    live = newest_committed(spark, table)
    return None if live is None else int(live.partition("=")[2])


def live_files(spark: SparkSession, table: str) -> DataFrame:
    """Files of the live snapshot of ``table`` (from the file listing; no file is opened); none without a snapshot."""
    return snapshot_files(spark, table).filter(F.col("snapshot") == F.lit(live_number(spark, table))).select("path")


def expired_files(spark: SparkSession, table: str, retention_hours: float = P.RETENTION_HOURS,
                  now_ms: int | None = None, fmt: str = "parquet") -> DataFrame:
    """Files of superseded snapshots of ``table`` older than the retention.

    Superseded are the snapshots below the live one; a snapshot above it is still being written, or
    was left half written, and is never listed. One metadata-only listing, no data file is opened.
    """
    now_ms = int(time.time() * 1000) if now_ms is None else now_ms
    cutoff = F.timestamp_millis(F.lit(now_ms - int(retention_hours * 3_600_000)))
    older = F.col("snapshot") < F.lit(live_number(spark, table))
    return (snapshot_files(spark, table).filter(older & (F.col("modificationTime") < cutoff))
            .select("path", "modificationTime", "length"))


def delete_files(expired: DataFrame) -> DataFrame:
    """Delete the listed files on the executors; returns ``path, deleted``."""
    def rm(batches):
        from pyarrow import fs as pafs
        for pdf in batches:
            done = []
            for p in pdf["path"]:
                filesystem, local = pafs.FileSystem.from_uri(p)
                try:
                    filesystem.delete_file(local)
                    done.append(True)
                except OSError:
                    done.append(False)
            yield pd.DataFrame({"path": pdf["path"], "deleted": done})
    ship_package(expired.sparkSession)
    return expired.select("path").mapInPandas(rm, "path string, deleted boolean")
