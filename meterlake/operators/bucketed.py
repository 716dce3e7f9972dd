"""Layers laid out by meter: bucketed tables, with hot meters apart.

Reports and the detector group readings by meter again and again. A bucketed
table pays for that shuffle once, when it is written: later aggregates,
windows and joins on the key read it bucket by bucket without an exchange.

A bucket is one task, so a meter with a third of all rows would undo the gain.
Such *hot* keys are kept in a second, plain folder, which is read in even
splits and handled by the operators' own ways (partial aggregates, the
detector's ranges). Every key lies in exactly one of the two parts, so a job
whose result for a key needs that key's rows alone can run over both and put
the results together (:func:`over_parts`).

Defined results: rows without a key are a key of their own; an empty layer
gives two empty parts.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.operators.joins import bucketed_table, dimension_join, settle
from meterlake.session import scratch_path

# Keys with more rows than this are kept apart (the detector's ranges are of this size too).
HOT_ROWS = 200_000
ROWS_PER_BUCKET = 4_000_000


class ByKey(NamedTuple):
    """A layer laid out by ``key``: ``cold`` in buckets, ``hot`` (keys of over ``HOT_ROWS`` rows) plain."""

    cold: DataFrame
    hot: DataFrame
    key: str
    buckets: int


def by_key(layer: DataFrame, key: str = "LCLid", sort: tuple[str, ...] = (), hot_rows: int = HOT_ROWS,
           buckets: int | None = None) -> ByKey:
    """Write a layer laid out by ``key`` (each file sorted by key, then ``sort``) and read it back.

    The layer is read three times (counts, cold, hot), so it should be a written one. Without ``buckets``
    there are at least as many as the session's shuffle partitions, which is what keeps a join from
    shuffling the bucketed side for more parallelism, and no more than ``ROWS_PER_BUCKET`` rows in each
    on average.
    """
    spark = layer.sparkSession
    counts = settle(layer.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows")))
    rows = counts.frame.agg(F.sum("_rows")).first()[0] or 0
    n = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_BUCKET))
    hot_keys = settle(counts.frame.filter(F.col("_rows") > hot_rows).select("_key"))
    same = F.col(key).eqNullSafe(F.col("_key"))
    cold = bucketed_table(dimension_join(layer, hot_keys, same, "left_anti"), key, n, sort)
    path = scratch_path(spark, "hot-keys")
    dimension_join(layer, hot_keys, same, "left_semi").write.parquet(path)
    return ByKey(cold, spark.read.schema(layer.schema).parquet(path), key, n)


def over_parts(layer: ByKey, job: Callable[..., DataFrame], **hot) -> DataFrame:
    """``job`` over the cold part and, with the arguments ``hot``, over the hot part; the results together."""
    return job(layer.cold).unionByName(job(layer.hot, **hot))
