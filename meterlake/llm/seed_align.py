"""Benchmark decontamination: rare n-gram seeds and Smith-Waterman alignment.

Seeds are word bigrams of the test items. An alignment that is told can afford
``budget`` errors at most (a word left off an end, replaced or dropped, or one
inserted), and no error breaks more bigrams than it costs in score: a word
inserted breaks one for 1, a word replaced or dropped two for 2, a word left
off one for 1. So of any ``budget + 1`` of an item's bigrams one is whole in every such
alignment, and the least expected ones, by the corpus frequencies of their
words, are the seeds. Frequencies only choose among sets that are all complete:
a common item has as many seeds as a rare one, at any size of the corpus.

Documents are read twice, for the word counts and for the seeds. Around each
hit the document's words are kept as a region of word hashes, as far as an
item can reach. Regions join items on the seed. By the same rule a region
without all but ``budget`` of the item's bigrams in as many words as an alignment
can span holds no leak; the other (region, item) pairs are aligned locally: a match counts 1, a substitution or a gap -1. The best
score as a share of the item's words, at least ``SHARE`` with ``LEAST`` matches,
tells a leak, also with words replaced, dropped or inserted.

The item side is kept to a bitmap of seed hashes of fixed size inside the
tasks; the join itself is left to Spark, so a benchmark of any size works.

Defined results: null or empty texts and items match nothing; an item with
fewer words than a seed is one seed; repeated rows and repeated items give a
row each; the first of equally good alignments is told; an empty table on
either side gives an empty result; extra columns are ignored by ``leaks`` and
passed through by ``without_leaks``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import (gather_ragged, hash_words, materialise, shingle_hashes, slices, split_words,
                                  two_columns)

GRAM = 2
SHARE = 0.5
LEAST = 6
BITMAP_BITS = 1 << 24

LEAKS = ("doc_id long, row long, item_id long, score double, matched long, first_word long, last_word long, "
         "text_hash long")


def bitmap_of(rows: DataFrame, column: str) -> bytes:
    """Bitmap of fixed size with the bit of every value (modulo its bits) set.

    The tasks fold their values into pieces of the bitmap, so the driver gets at most
    ``BITMAP_BITS`` / 32768 rows of 4 KB, however many values there are.
    """
    place = F.pmod(F.col(column), F.lit(BITMAP_BITS)) + 1  # Spark's bitmaps count from 1
    pieces = (rows.select(F.bitmap_bucket_number(place).alias("piece"), F.bitmap_bit_position(place).alias("bit"))
              .groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("bits")))
    out = np.zeros(BITMAP_BITS >> 3, np.uint8)
    for r in pieces.collect():
        bits = np.frombuffer(r["bits"], np.uint8)
        out[(r["piece"] - 1) * len(bits):][:len(bits)] = bits
    return out.tobytes()


def in_bitmap(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = (values.view(np.int64) & (BITMAP_BITS - 1)).astype(np.int64)
    return (bitmap[at >> 3] >> (at & 7)) & 1 > 0


def word_sequences(items: DataFrame, gram: int) -> DataFrame:
    """(id, words, grams): word hashes of each text and the hash of every n-gram."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in slices(batches):
            codes, words, first = split_words(texts, lower=True)
            h = hash_words(words)[codes]
            g, bounds = shingle_hashes(h, first, gram)
            yield pa.RecordBatch.from_arrays(
                [keys, pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(h.view(np.int64))),
                 pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(g.view(np.int64)))],
                names=["item_id", "words", "grams"])

    return items.mapInArrow(run, "item_id long, words array<long>, grams array<long>")


def word_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(word, n) in the documents for the vocabulary's words, and n under the null word for all words."""
    bitmap = bitmap_of(vocabulary, "word")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.frombuffer(bitmap, np.uint8)
        for _, texts in slices(batches):
            codes, words, _ = split_words(texts, lower=True)
            h, n = hash_words(words), np.bincount(codes, minlength=len(words))
            at = np.flatnonzero(in_bitmap(wanted, h))
            yield pa.RecordBatch.from_arrays(
                [pa.array([*h[at].view(np.int64).tolist(), None], pa.int64()),
                 pa.array([*n[at].tolist(), len(codes)], pa.int64())], names=["word", "n"])

    return docs.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def budget_of(words: int, share: float, least: int) -> int:
    """Largest loss of score that still leaves an item of so many words told."""
    return math.floor(words - max(share * words, min(least, words)) + 1e-9)


def seeds_of(docs: DataFrame, items: DataFrame, gram: int, share: float, least: int) -> DataFrame:
    """(item, gram) of the items' seeds: of each, so many least expected grams that its budget cannot break all."""
    vocabulary = items.select(F.explode("words").alias("word")).distinct()
    counts = materialise(word_counts(docs, vocabulary), "benchmark_word_counts")
    total = counts.filter("word is null").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    size = F.size("words")
    budget = F.floor(size - F.greatest(F.lit(share) * size, F.least(F.lit(least), size)) + 1e-9)
    need = budget * max(gram - 1, 1) + 1
    places = items.select("item", "words", need.alias("need"), F.posexplode("grams").alias("at", "gram"))
    words = places.select("item", "gram", "at", "need", F.explode(F.slice("words", F.col("at") + 1, gram)).alias("word"))
    known = counts.filter("word is not null")
    part = F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(float(total + 1)))
    chance = words.join(known, "word", "left").groupBy("item", "at", "gram", "need").agg(F.sum(part).alias("log_share"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy("log_share", "at"))
    return chance.withColumn("rank", rank).filter("rank <= need").select("item", "gram").distinct()


def regions(docs: DataFrame, seeds: DataFrame, gram: int, reach: int) -> DataFrame:
    """(doc_id, row, start, words, grams, text_hash): stretches of documents around their seed hits."""
    bitmap = bitmap_of(seeds, "gram")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        wanted = np.frombuffer(bitmap, np.uint8)
        row = TaskContext.get().partitionId() << 33
        for keys, texts, hashes in slices(batches):
            codes, words, first = split_words(texts, lower=True)
            h = hash_words(words)[codes]
            g, bounds = shingle_hashes(h, first, gram)
            hit = np.flatnonzero(in_bitmap(wanted, g))
            doc = np.searchsorted(bounds, hit, side="right") - 1
            at = first[doc] + hit - bounds[doc]
            lo, hi = np.maximum(at - reach, first[doc]), np.minimum(at + gram + reach, first[doc + 1])
            head = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (lo[1:] > hi[:-1]))) if len(hit) else hit
            size = np.diff(np.append(head, len(hit)))
            start, end = lo[head], (np.maximum.reduceat(hi, head) if len(head) else hi)
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(doc[head])), pa.array(row + doc[head]), pa.array(start - first[doc[head]]),
                 pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(end - start)), pa.int32()),
                                          pa.array(h[gather_ragged(start, end - start)].view(np.int64))),
                 pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()),
                                          pa.array(g[hit].view(np.int64))), hashes.take(pa.array(doc[head]))],
                names=["doc_id", "row", "start", "words", "grams", "text_hash"])
            row += len(keys)

    return (docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
            .mapInArrow(run, "doc_id long, row long, start long, words array<long>, grams array<long>, text_hash long"))


def may_hold(item: np.ndarray, text: np.ndarray, budget: int) -> bool:
    """Whether some stretch an alignment can span has all but ``budget`` of the item's bigrams: none is told elsewhere."""
    need = len(item) - 1 - budget
    if need <= 0 or len(text) < 2:
        return need <= 0
    first, second = np.unique(item, return_inverse=True)
    at = np.searchsorted(first, text)
    code = np.where(first[np.minimum(at, len(first) - 1)] == text, np.minimum(at, len(first) - 1), -1)
    pairs = np.unique(second[:-1] * len(first) + second[1:])
    whole = (code[:-1] >= 0) & (code[1:] >= 0) & np.isin(code[:-1] * len(first) + code[1:], pairs)
    total = np.concatenate([[0], np.cumsum(whole)])
    span = min(len(item) + budget - 1, len(whole))
    return bool((total[span:] - total[:-span]).max() >= need)


def smith_waterman(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(best local score, text position after its end) with match 1, substitution -1, gap -1; the first best one."""
    step = np.arange(len(text) + 1)
    above = np.zeros(len(text) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        row = np.zeros_like(above)
        row[1:] = np.maximum(above[:-1] + np.where(text == word, 1, -1), above[1:] - 1)
        # a gap costs 1 a step: the best start to the left is a running maximum of score + place
        row = np.maximum(np.maximum.accumulate(np.maximum(row, 0) + step) - step, 0)
        top = int(row.max())
        if top > best:
            best, end = top, int(row.argmax())
        above = row
    return best, end


def aligned(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(score, first, end) of the best local alignment; the start comes from aligning backwards from its end."""
    score, end = smith_waterman(item, text)
    if not score:
        return 0, 0, 0
    _, back = smith_waterman(item[::-1], text[:end][::-1])
    return score, end - back, end


def leaks(docs: DataFrame, items: DataFrame, gram: int = GRAM, share: float = SHARE, least: int = LEAST,
          key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, row, item_id, score, matched, first_word, last_word, text_hash) of every leaked item in every row."""
    docs = two_columns(docs, key, text)
    items = materialise(word_sequences(two_columns(items, item_key, item_text), gram).filter(F.size("words") > 0)
                        .withColumn("item", F.xxhash64("words")), "benchmark_items")
    one = items.dropDuplicates(["item"])
    seeds = materialise(seeds_of(docs, one, gram, share, least), "seeds")
    longest = items.agg(F.coalesce(F.max(F.size("words")), F.lit(0)).alias("n")).first()["n"]
    found = materialise(regions(docs, seeds, gram, longest + budget_of(longest, share, least)), "regions")
    pairs = (found.select("row", "start", F.explode(F.array_distinct("grams")).alias("gram"))
             .join(seeds, "gram").select("row", "start", "item").distinct())
    texts = items.select("item", "item_id", F.col("words").alias("item_words")).dropDuplicates(["item", "item_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            doc_ids, rows, starts, item_ids = (batch.column(c).to_pylist() for c in range(4))
            hashes = batch.column(6).to_pylist()
            for k in range(batch.num_rows):
                words, item = (batch.column(c)[k].values.to_numpy(zero_copy_only=False) for c in (4, 5))
                if not may_hold(item, words, budget_of(len(item), share, least)):
                    continue
                score, a, b = aligned(item, words)
                if score >= share * len(item) and score >= min(least, len(item)):
                    out.append((doc_ids[k], rows[k], item_ids[k], score / len(item), score, starts[k] + a,
                                starts[k] + b - 1, hashes[k]))
            columns = list(zip(*out)) or [()] * 8
            kinds = (*[pa.int64()] * 3, pa.float64(), *[pa.int64()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)],
                                             names=[c.split()[0] for c in LEAKS.split(", ")])

    candidates = (pairs.join(found.select("doc_id", "row", "start", "words", "text_hash"), ["row", "start"])
                  .join(texts, "item")
                  .select("doc_id", "row", "start", "item_id", "words", "item_words", "text_hash"))
    return candidates.mapInArrow(run, LEAKS)


def without_leaks(df: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``df``, all columns, whose text holds no test item; rows are matched by id and text, nulls included."""
    out = (leaks(df, items, key=key, text=text, **options)
           .select(F.col("doc_id").alias("leaked_id"), F.col("text_hash").alias("leaked_hash")).distinct())
    return df.join(out, df[key].cast("long").eqNullSafe(out["leaked_id"])
                   & (F.xxhash64(df[text].cast("string")) == out["leaked_hash"]), "left_anti")
