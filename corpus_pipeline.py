"""The corpus pipeline: quality rules, near-dedup, decontamination, PII, packing, in this order.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept.
All but the last return the columns of ``documents``; the last returns the
pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterlake.llm import cost_packing, fertility, odd_sketch, pii_boost, seed_align
from meterlake.llm.common import materialise, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie in the fertility bands of their language."""
    return fertility.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates."""
    return odd_sketch.without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, whole or edited."""
    return seed_align.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by the name of its kind."""
    return pii_boost.redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens."""
    return cost_packing.packed_sequences(docs)


STAGES = [("quality rules", quality), ("near-duplicates", near_dedup), ("decontamination", decontamination),
          ("personal data", pii), ("packing", packing)]

# The stages use tokenizers, trained trees and alignments, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
