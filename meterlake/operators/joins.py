"""Dimension joins with a checked broadcast.

A dimension is broadcast only after its size has been measured: one small
aggregate job counts its rows and payload bytes. Beyond the limit the join is
left to the planner (sort-merge / shuffled hash, which AQE may still turn
into a broadcast from runtime sizes, and whose skewed partitions AQE splits).
The household dimension grows with the number of meters, so at cluster scale
it can outgrow any fixed broadcast budget; the weather dimension has one row
per hour and stays small.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.session import scratch_path

# Broadcast budget of a dimension (serialized payload estimate).
DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def _payload_bytes(df: DataFrame) -> Column:
    parts = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)).cast("long"))
        elif isinstance(f.dataType, T.ArrayType):  # of fixed-width values
            parts.append(F.coalesce(F.size(F.col(f"`{f.name}`")), F.lit(0)).cast("long") * 8)
        else:
            parts.append(F.lit(8).cast("long"))
    total = F.lit(16).cast("long")  # per-row overhead of an unsafe row header
    for p in parts:
        total = total + p
    return total


class Settled(NamedTuple):
    """A dimension written to the shared scratch folder, and what it measures."""

    frame: DataFrame
    rows: int
    bytes: int
    path: str


def settle(df: DataFrame) -> Settled:
    """Compute a dimension once: write it as parquet, read it back, and count its rows and payload bytes.

    The copy belongs to this DataFrame alone: a later read of a grown
    table is written and measured anew, and a lost executor costs a re-read of files.
    A running stream keeps the dimension it was started with.
    """
    path = scratch_path(df.sparkSession, "dimension")
    df.write.parquet(path)
    frame = df.sparkSession.read.schema(df.schema).parquet(path)
    row = frame.agg(F.count(F.lit(1)).alias("n"), F.sum(_payload_bytes(frame)).alias("b")).first()
    return Settled(frame, int(row["n"] or 0), int(row["b"] or 0), path)


def bucketed_table(df: DataFrame, key: str, buckets: int, sort: tuple[str, ...] = ()) -> DataFrame:
    """``df`` written as parquet in ``buckets`` buckets of ``key``, one file each, and read back as a table.

    Aggregates, windows and joins on the key find the layout and do not shuffle it again. The files
    lie in the shared scratch folder; the table's name belongs to this session's catalog.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "buckets")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    (df.repartition(buckets, F.col(key)).write.bucketBy(buckets, key).sortBy(key, *sort)
     .option("path", path).format("parquet").saveAsTable(name))
    return spark.table(name)


def laid_out(settled: Settled, key: str) -> DataFrame:
    """The dimension in as many buckets of ``key`` as the session has shuffle partitions."""
    n = int(settled.frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return bucketed_table(settled.frame, key, n)


def settle_all(dims: list[DataFrame]) -> list[Settled]:
    """Settle several dimensions; their jobs run concurrently."""
    with ThreadPoolExecutor(max_workers=max(1, len(dims))) as pool:
        return list(pool.map(settle, dims))


def dimension_join(fact: DataFrame, dim: DataFrame | Settled, on, how: str,
                   max_broadcast_bytes: int | None = DEFAULT_MAX_BROADCAST_BYTES,
                   dim_key: str | None = None) -> DataFrame:
    """Join a fact DataFrame to a dimension, broadcasting the dimension only if it is measured small.

    A dimension over the budget is joined by shuffle; with ``dim_key`` it is
    first written in buckets of that key, so
    repeated joins (every micro-batch of a stream-static join) shuffle only
    the fact side. ``max_broadcast_bytes=None`` skips the check and leaves
    the choice to the planner.
    """
    if max_broadcast_bytes is not None:
        settled = dim if isinstance(dim, Settled) else settle(dim)
        dim = settled.frame
        if settled.bytes <= max_broadcast_bytes:
            dim = F.broadcast(dim)
        elif dim_key is not None:
            dim = laid_out(settled, dim_key)
    return fact.join(dim, on, how)
