"""Quality rules from tokeniser fertility.

A public vocabulary with byte fallback measures every text: characters per
token, share of byte-fallback tokens, and token entropy relative to the most
that so many tokens could have. Text the vocabulary was not made for (caps,
symbol noise, broken encodings, loops) lies outside the band that documents of
its language usually keep. The bands are robust ones, from quartiles over all
documents that pass the base rules: one pass measures, two small aggregates
set the bands, one join judges. Characters per token are a mean over words, so
their band is wider for short texts, as the square root of the word count; its
width comes from the quartiles of the deviations scaled back by that root.
Bands have a least half-width, so a language of few or identical documents
does not reject its own.

The distinct words of a slice are tokenised once; per-document figures are
array sums over word codes.

Defined results: a null or empty text has no words and fails the base rules
(fewer than 20 words); a null or empty language is replaced by the script most
of the text's words are in; repeated rows are judged each and alike; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import gather_ragged, materialise, mix, shingle_hashes, slices, split_words
from meterlake.llm.graph import checked_broadcast

CACHE_WORDS = 300_000
SYMBOLS = "#*$%&|<>"
BLANK = " \t\n\v\f\r"

# First code points of the script ranges told apart, in order.
SCRIPT_STARTS = [0x0, 0x370, 0x400, 0x530, 0x590, 0x600, 0x700, 0x900, 0x980, 0xE00, 0xE80, 0x1100, 0x1200,
                 0x1E00, 0x1F00, 0x2000, 0x3040, 0x3400, 0xAC00, 0xD7B0, 0x20000]
SCRIPT_NAMES = ["Latin", "Greek", "Cyrillic", "Armenian", "Hebrew", "Arabic", "Other", "Devanagari", "Indic", "Thai",
                "Other", "Hangul", "Other", "Latin", "Greek", "Other", "Kana", "Han", "Hangul", "Other", "Han"]

METRICS = ("doc_id long, text_hash long, band string, n_words long, word_chars long, n_symbols long, "
           "n_dup_lines long, n_repeat_words long, base_failed boolean, n_pieces long, chars_per_token double, "
           "byte_share double, entropy_share double")


@dataclass(frozen=True)
class Bands:
    """How far from the middle a figure may lie: ``reach`` times the quartiles' distance, ``least`` at any rate."""

    reach: float = 4.0
    reach_chars_per_token: float = 3.0
    least_chars_per_token: float = 0.08
    least_byte_share: float = 0.08
    least_entropy_share: float = 0.12


class PieceTable:
    """Word -> piece ids under the vocabulary with byte fallback; each distinct word is encoded once."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.size)])
        self.ids: dict[str, bytes] = {}  # 32-bit ids

    def ragged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat ids, start, length) of each word."""
        if len(self.ids) > CACHE_WORDS:
            self.ids.clear()
        new = [w for w in words if w not in self.ids]
        if new:
            for w, x in zip(new, self.model.encode(new, num_threads=1)):
                self.ids[w] = array("i", x).tobytes()
        each = [self.ids[w] for w in words]
        length = np.array([len(x) for x in each], np.int64) // 4
        return np.frombuffer(b"".join(each), np.int32), np.cumsum(length) - length, length


@lru_cache(maxsize=2)
def pieces_of(path: str) -> PieceTable:
    return PieceTable(path)


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of a word-wise array over each text."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[first])


def repeated_window_words(codes: np.ndarray, first: np.ndarray, width: int = 8) -> np.ndarray:
    """Per text, the words that lie in a ``width``-word window found more than once in that text."""
    with np.errstate(over="ignore"):
        h, bounds = shingle_hashes(mix(codes.astype(np.uint64) + np.uint64(1)), first, width)
        doc = np.repeat(np.arange(len(first) - 1), np.diff(bounds))
        h = h ^ mix(doc.astype(np.uint64) + np.uint64(1))
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    found = np.zeros(len(h), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    at = np.flatnonzero(found)
    start = first[doc[at]] + at - bounds[doc[at]]
    step = np.zeros(len(codes) + 1, np.int64)
    np.add.at(step, start, 1)
    np.add.at(step, np.minimum(start + width, len(codes)), -1)
    return per_text((np.cumsum(step)[:-1] > 0).astype(np.int64), first)


def main_script(words: list[str], length: np.ndarray, codes: np.ndarray, first: np.ndarray) -> list[str]:
    """The script in which most word characters of each text lie, told by each word's first letter."""
    start = np.array([next((ord(c) for c in w if c.isalpha()), -1) for w in words] or [0], np.int64)
    kind = np.where(start < 0, 0, np.searchsorted(SCRIPT_STARTS, start, side="right"))
    n = len(SCRIPT_NAMES) + 1
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    weight = np.bincount(doc * n + kind[codes], weights=length[codes], minlength=(len(first) - 1) * n)
    weight = weight.reshape(-1, n)[:, 1:]
    return [SCRIPT_NAMES[k] if w > 0 else "None" for k, w in zip(weight.argmax(1), weight.max(1, initial=0))]


def measure(texts: pa.Array, languages: list[str | None], table: PieceTable) -> dict[str, object]:
    """All figures of a slice of texts."""
    codes, words, first = split_words(texts, lower=False)
    n_words = np.diff(first)
    chars = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    word_chars = per_text(chars[codes], first)
    plain = texts.to_pylist()
    n_symbols = np.array([sum(t.count(c) for c in SYMBOLS) for t in plain], np.int64)
    dup_lines = []
    for t in plain:
        lines = [x for x in t.split("\n") if x.strip(BLANK)]
        dup_lines.append(len(lines) - len(set(lines)))
    repeat = repeated_window_words(codes, first)
    listed = words.to_pylist()
    flat, start, length = table.ragged(listed)
    ids = flat[gather_ragged(start[codes], length[codes])]
    n_pieces = per_text(length[codes], first)
    piece_first = np.concatenate([[0], np.cumsum(n_pieces)])
    n_bytes = per_text(table.is_byte[ids].astype(np.int64), piece_first)
    doc = np.repeat(np.arange(len(n_pieces)), n_pieces)
    pairs, times = np.unique(doc * table.size + ids, return_counts=True)
    inner = np.bincount(pairs // table.size, weights=times * np.log2(times), minlength=len(n_pieces))
    some = np.maximum(n_pieces, 1)
    entropy = np.where(n_pieces > 0, np.log2(some) - inner / some, 0.0)
    scripts = None
    if not all(languages):
        scripts = main_script(listed, chars, codes, first)
    return {
        "band": [x or scripts[i] for i, x in enumerate(languages)],
        "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": np.array(dup_lines, np.int64),
        "n_repeat_words": repeat, "base_failed": (n_words < 20) | (100 * repeat > 30 * n_words),
        "n_pieces": n_pieces, "chars_per_token": word_chars / some, "byte_share": n_bytes / some,
        "entropy_share": np.where(n_pieces > 1, entropy / np.log2(np.maximum(some, 2)), 1.0),
    }


def fertility_metrics(df: DataFrame, vocabulary: str | None = None, key: str = "doc_id", text: str = "text",
                      language: str | None = "lang") -> DataFrame:
    """One row of figures per row of ``df``; ``band`` names the language or script it is judged in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers
        table = pieces_of(vocabulary or public_tokenizers.path("piece_bpe_32k.model"))
        for keys, texts, hashes, langs in slices(batches):
            figures = measure(texts, [x or None for x in langs.to_pylist()], table)
            yield pa.RecordBatch.from_arrays(
                [keys, hashes, *(pa.array(x) for x in figures.values())],
                names=["doc_id", "text_hash", *figures])

    lang = F.col(language).cast("string") if language in df.columns else F.lit(None).cast("string")
    return df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                     F.xxhash64(F.col(text).cast("string")).alias("text_hash"), lang.alias("lang")
                     ).mapInArrow(run, METRICS)


def bands_of(metrics: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """Band per language or script, from the quartiles over all documents that pass the base rules."""
    def quartiles(value: Column) -> Column:
        return F.percentile_approx(value, [0.25, 0.5, 0.75], 10_000)

    def reach(name: str, least: float) -> Column:
        return F.greatest((F.col(name)[2] - F.col(name)[0]) * bands.reach, F.lit(least))

    sound = metrics.filter(~F.col("base_failed"))
    level = sound.groupBy("band").agg(
        *(quartiles(F.col(x)).alias(f"q_{x}") for x in ("chars_per_token", "byte_share", "entropy_share"))).select(
        "band", F.col("q_chars_per_token")[1].alias("middle_chars"),
        (F.col("q_byte_share")[2] + reach("q_byte_share", bands.least_byte_share)).alias("high_bytes"),
        (F.col("q_entropy_share")[0] - reach("q_entropy_share", bands.least_entropy_share)).alias("low_entropy"))
    level = checked_broadcast(materialise(level, "band_levels"))
    spread = (sound.join(level, "band").groupBy("band").agg(
        quartiles((F.col("chars_per_token") - F.col("middle_chars")) * F.sqrt("n_words")).alias("q"))
        .select("band", ((F.col("q")[2] - F.col("q")[0]) * bands.reach_chars_per_token).alias("spread_chars")))
    return level.join(spread, "band")


def fertility_rules(df: DataFrame, bands: Bands = Bands(), **columns) -> DataFrame:
    """The figures of every row with ``kept``: base rules passed and inside the bands of its language or script."""
    metrics = materialise(fertility_metrics(df, **columns), "fertility")
    away = F.abs(F.col("chars_per_token") - F.col("middle_chars"))
    inside = ((away <= F.lit(bands.least_chars_per_token) + F.col("spread_chars") / F.sqrt("n_words"))
              & (F.col("byte_share") <= F.col("high_bytes")) & (F.col("entropy_share") >= F.col("low_entropy")))
    edges = checked_broadcast(materialise(bands_of(metrics, bands), "bands"))
    return (metrics.join(edges, "band", "left")
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False))))


def kept_documents(df: DataFrame, bands: Bands = Bands(), **columns) -> DataFrame:
    """The rows of ``df``, all columns, whose text passes; rows are matched by id and text, nulls included."""
    key, text = columns.get("key", "doc_id"), columns.get("text", "text")
    out = (fertility_rules(df, bands, **columns).filter(~F.col("kept"))
           .select(F.col("doc_id").alias("rejected_id"), F.col("text_hash").alias("rejected_hash")).distinct())
    return df.join(out, df[key].cast("long").eqNullSafe(out["rejected_id"])
                   & (F.xxhash64(df[text].cast("string")) == out["rejected_hash"]), "left_anti")
