"""Registered queries of the training-data operators, and their DuckDB twins where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterlake.llm import (bpr_dedup, compact_windows, cost_packing, crf_html, fertility, label_shards, lm_trie, odd_sketch,
                           orchard_codes, pii_boost, prefix_trie, rank_count, seed_align)
from meterlake.llm.common import table
from meterlake.llm.oracle import ORACLE  # noqa: F401


def op1_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_trie.language_model_scores(table(spark, sf_dir, "documents"))


def op2_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fertility.fertility_rules(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       "kept", "band", "chars_per_token", "byte_share", "entropy_share")


def op3_bucket_pointer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpr_dedup.without_repeated_strings(table(spark, sf_dir, "documents"))


def op4_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cost_packing.packed_sequences(table(spark, sf_dir, "documents"))


def op5_rank_synchronous_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_count.token_counts(table(spark, sf_dir, "documents"))


def op6_candidate_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_boost.personal_data(table(spark, sf_dir, "documents"))


def op7_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_windows.near_duplicate_passages(table(spark, sf_dir, "documents"))


def op8_crf_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf_html.extracted(table(spark, sf_dir, "pages"))


def op9_odd_sketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.near_duplicates(table(spark, sf_dir, "documents"), words=3, similarity=0.85)


def op10_seed_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (seed_align.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
            .select("doc_id", "item_id", "score", "matched", "first_word", "last_word"))


def op11_balanced_label_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_shards.sharded_documents(table(spark, sf_dir, "documents"))


def op12_orchard_product_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchard_codes.product_codes(table(spark, sf_dir, "embeddings"))


def op13_collapsed_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_nodes(table(spark, sf_dir, "conversations"))


# Tokenizers, trained models, hash sketches and propagation are beyond SQL: tests compare those queries with brute force.
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_elias_fano_lm, op2_tokeniser_fertility, op3_bucket_pointer_dedup, op4_cost_balanced_packing,
    op5_rank_synchronous_counts, op6_candidate_boosting, op7_compact_windows, op8_crf_main_text,
    op9_odd_sketch_near_dedup, op10_seed_alignment, op11_balanced_label_shards, op12_orchard_product_codes,
    op13_collapsed_prefix_trie)}
