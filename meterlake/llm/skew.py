"""Joins of many rows to one fact per key, where one key may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_PARTS = 1000


def hot_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of more than one thousandth of all ``rows`` (a written table): fewer than a thousand, held by the driver.

    The count combines inside each task before its shuffle.
    """
    total = rows.count()
    hot = rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") * HOT_PARTS > total).select(*keys)
    return rows.sparkSession.createDataFrame(hot.collect(), hot.schema)


def spread_join(rows: DataFrame, facts: DataFrame, keys: list[str], how: str = "inner",
                hot: DataFrame | None = None) -> DataFrame:
    """``rows`` (a written table) with the ``facts`` (at most one row a key) of their ``keys``; ``how``: inner or left.

    The facts of hot keys are broadcast and the rows of those keys stay where they
    are; all other rows are joined by a shuffle in which no key is large. Keys are not null.
    """
    hot = F.broadcast(hot_keys(rows, keys) if hot is None else hot)
    here = rows.join(hot, keys, "left_semi").join(F.broadcast(facts.join(hot, keys, "left_semi")), keys, how)
    shuffled = rows.join(hot, keys, "left_anti").join(facts.join(hot, keys, "left_anti"), keys, how)
    return here.unionByName(shuffled)
