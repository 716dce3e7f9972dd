"""Connected components of a large edge table, and joins whose small side is checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import materialise


def checked_broadcast(small: DataFrame, max_rows: int = 20_000) -> DataFrame:
    """``small`` (a written table) with a broadcast hint if it has at most ``max_rows`` rows, else as it is."""
    return F.broadcast(small) if small.limit(max_rows + 1).count() <= max_rows else small


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the undirected ``edges`` (a, b); the label is the component's least node.

    Every round takes the least label around each node and then the label of
    that label, so long chains shrink by pointer jumping. Labels only fall, and
    a round without a change ends the loop. A node with very many neighbours
    is pre-aggregated before the shuffle.
    """
    both = materialise(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")),
                         "labels")
    while True:
        near = (both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near")))
        lower = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        new = materialise(lower.join(jump, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("jump", "label")).alias("label")), "labels")
        changed = new.filter(F.col("label") != F.col("old")).limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels
