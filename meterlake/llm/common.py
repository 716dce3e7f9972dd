"""Helpers shared by the training-data operators.

Text columns reach Python as Arrow batches; these helpers cut a batch into
slices of a bounded number of text bytes, split whole slices into words with
Arrow kernels, and map words to 64-bit hashes. Nothing here looks at more
than one slice at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.session import scratch_path, ship_package

SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table by name; ``ship_package`` makes this package importable in the workers."""
    ship_package(spark)
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def two_columns(df: DataFrame, key: str, text: str) -> DataFrame:
    """Key (long) and text (string) only, under fixed names, so extra or clashing columns do not matter."""
    return df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back.

    Cuts the lineage: an executor lost later costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], max_bytes: int = SLICE_BYTES) -> Iterator[tuple[pa.Array, ...]]:
    """(keys, texts, further columns) slices of at most ``max_bytes`` of text, or one row; a null text becomes empty."""
    for batch in batches:
        keys, texts = batch.column(0), pc.fill_null(batch.column(1).cast(pa.string()), "")
        size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        total, first = np.cumsum(size), 0
        while first < len(size):
            base = total[first] - size[first]
            end = max(int(np.searchsorted(total, base + max_bytes, side="right")), first + 1)
            yield (keys.slice(first, end - first), texts.slice(first, end - first),
                   *(c.slice(first, end - first) for c in batch.columns[2:]))
            first = end


def split_words(texts: pa.Array, lower: bool) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text: (code per word, distinct words, first word of each text).

    ``lower`` lower-cases A-Z only. The last array has one entry more than
    there are texts.
    """
    if lower:
        texts = pc.ascii_lower(texts)
    parts = pc.ascii_split_whitespace(texts)
    bounds = parts.offsets.to_numpy().astype(np.int64)
    flat = parts.values.slice(int(bounds[0]), int(bounds[-1] - bounds[0]))
    real = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    encoded = flat.filter(real).dictionary_encode()
    return (encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary,
            before[bounds - bounds[0]].astype(np.int64))


def hash_words(words: pa.Array) -> np.ndarray:
    """64-bit hash of each word's UTF-8 bytes."""
    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(w) for w in words.cast(pa.binary()).to_pylist()), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler (two multiply-xorshift rounds), for uint64 arrays."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def gather_ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges ``[starts[i], starts[i] + lengths[i])``."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.repeat(starts.astype(np.int64) - (ends - lengths), lengths) + np.arange(ends[-1])


def shingle_hashes(word_hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``n`` words inside one text: (hash per run, first run of each text).

    A text with 1 to n-1 words yields one run, its whole sequence; an empty
    text none.
    """
    counts = np.diff(first)
    runs = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    at = gather_ragged(first[:-1], runs)
    width = np.repeat(np.minimum(counts, n), runs)
    out = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            here = word_hashes[np.minimum(at + k, max(len(word_hashes) - 1, 0))] if len(word_hashes) else out
            grown = mix(out * np.uint64(0x9E3779B97F4A7C15) + here + np.uint64(1))
            out = np.where(k < width, grown, out)
        out = mix(out + width.astype(np.uint64))
    return out, np.concatenate([[0], np.cumsum(runs)]).astype(np.int64)
