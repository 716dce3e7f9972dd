"""Near-duplicate documents by MinHash bands, odd sketches and exact confirmation.

Every text becomes its set of distinct word shingles. One pass gives each set
an identity, MinHash samples grouped into band keys, and an odd sketch: every
sample flips one bit of a small bitmap, so the population count of two
bitmaps' XOR estimates how many samples differ, precisely for similar sets.
Equal sets are one node from there on, so exact copies cost nothing further.

Nodes that share a band key are a bucket. In a bucket all nodes are compared
with a hub first, twice, and at last across what are still different
components of the bucket. Hubs are nodes with many bucket neighbours, the
middle of a group of copies, and so few and the same in most buckets of it.
Compared means: sizes allow the similarity, the odd sketches allow it with a
wide margin, and the full sets confirm it. Pairs of one component are never
compared again, so a group of thousands of near copies costs about one
comparison for each, and no group's pairs are all emitted.

Two sets at the similarity miss each other in all bands with probability below
``MISS``.

Defined results: a null or empty text, or one without words, has 0 shingles and
is linked with nothing; with fewer words than a shingle the whole sequence is
one; repeated rows and equal texts are linked; the smallest id of a component
stands for it, and a row without an id belongs to the component of its text but
stands for it only if no row has an id; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import hash_words, materialise, mix, shingle_hashes, slices, split_words, two_columns
from meterlake.llm.graph import checked_broadcast, components

ROWS = 4
MISS = 1e-7
SAMPLES = 400
BITS = 1024
MARGIN = 4.0
SLICE = 1 << 20  # text bytes made into shingles at once

SKETCH_COLUMNS = [f"odd{k}" for k in range(BITS // 64)]
SKETCHES = ("doc_id long, text_hash long, n_shingles long, node long, bands array<long>, "
            + ", ".join(f"{c} long" for c in SKETCH_COLUMNS))


def bands_for(similarity: float, rows: int = ROWS, miss: float = MISS) -> int:
    """Number of bands of ``rows`` samples at which sets of that similarity share none with probability ``miss``."""
    return math.ceil(math.log(miss) / math.log1p(-similarity ** rows))


def distinct_shingles(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text: (hashes, first of each text)."""
    codes, vocabulary, first = split_words(texts, lower=True)
    with np.errstate(over="ignore"):
        h, bounds = shingle_hashes(hash_words(vocabulary)[codes], first, words)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(len(bounds)))


def identities(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """64-bit identity of each set (0 for an empty one), independent of order."""
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(h + np.uint64(0x51)), dtype=np.uint64)])[first]
        total = mix(np.diff(sums) + np.diff(first).astype(np.uint64))
    return np.where(np.diff(first) > 0, total | np.uint64(1), np.uint64(0)).astype(np.int64)


def samples(h: np.ndarray, first: np.ndarray, n: int, seed: int = 7) -> np.ndarray:
    """(n, texts) MinHash samples of non-empty sets, 32 bits each."""
    rng = np.random.default_rng(seed)
    flip = rng.integers(0, 2 ** 32, n, dtype=np.uint32)
    factor = rng.integers(0, 2 ** 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    out = np.empty((n, len(first) - 1), np.uint32)
    low, top, buffer = (h >> np.uint64(32)).astype(np.uint32), h.astype(np.uint32), np.empty(len(h), np.uint32)
    with np.errstate(over="ignore"):
        for k in range(n):
            np.bitwise_xor(low if k % 2 else top, flip[k], out=buffer)
            np.multiply(buffer, factor[k], out=buffer)
            out[k] = np.minimum.reduceat(buffer, first[:-1])
    return out


def odd_bitmaps(sample: np.ndarray) -> np.ndarray:
    """(texts, BITS / 64) parity bitmaps: sample k of a text flips the bit that k and its value choose."""
    n, texts = sample.shape
    with np.errstate(over="ignore"):
        at = mix(sample.astype(np.uint64) + (np.arange(n, dtype=np.uint64) << np.uint64(32))[:, None]) % np.uint64(BITS)
    flips = np.bincount((at + np.arange(texts, dtype=np.uint64) * np.uint64(BITS)).ravel().astype(np.int64),
                        minlength=texts * BITS)
    return np.packbits((flips & 1).astype(np.uint8).reshape(texts, BITS), axis=1).view(np.int64)


def sketches(docs: DataFrame, words: int, n_bands: int) -> DataFrame:
    """Identity, band keys and odd sketch of every row's shingle set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts, hashes in slices(batches, SLICE):
            h, first = distinct_shingles(texts, words)
            size = np.diff(first)
            some = np.flatnonzero(size)
            band = np.zeros((len(size), n_bands), np.int64)
            odd = np.zeros((len(size), len(SKETCH_COLUMNS)), np.int64)
            if len(some):
                sample = samples(h, np.append(first[some], len(h)), max(SAMPLES, n_bands * ROWS))
                odd[some] = odd_bitmaps(sample)
                with np.errstate(over="ignore"):
                    for b in range(n_bands):
                        key = np.full(len(some), b + 1, np.uint64)
                        for r in range(ROWS):
                            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sample[b * ROWS + r].astype(np.uint64))
                        band[some, b] = key.astype(np.int64)
            used = np.where(size > 0, n_bands, 0)
            bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(used)]), pa.int32()),
                                             pa.array(band[some].ravel()))
            yield pa.RecordBatch.from_arrays(
                [keys, hashes, pa.array(size), pa.array(identities(h, first)), bands, *(pa.array(c) for c in odd.T)],
                names=["doc_id", "text_hash", "n_shingles", "node", "bands", *SKETCH_COLUMNS])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(run, SKETCHES)


def estimate(n_samples: int) -> Column:
    """Similarity by the odd sketches of nodes a and b."""
    away = sum((F.bit_count(F.col(f"a.{c}").bitwiseXOR(F.col(f"b.{c}"))) for c in SKETCH_COLUMNS), F.lit(0))
    inner = F.greatest(F.lit(1e-9), 1 - 2 * away / F.lit(float(BITS)))
    return 1 + F.log(inner) * F.lit(BITS / (4.0 * n_samples))


class NearDuplicates:
    """Links between the distinct shingle sets of a document table."""

    def __init__(self, docs: DataFrame, words: int, similarity: float):
        self.docs, self.words = docs, words
        self.percent = round(similarity * 100)
        n_bands = bands_for(similarity)
        n_samples = max(SAMPLES, n_bands * ROWS)
        # a sample differs with probability 1 - similarity; the estimate may miss by MARGIN deviations
        self.least = similarity - MARGIN * math.sqrt(similarity * (1 - similarity) / n_samples)
        self.possible = estimate(n_samples) >= F.lit(self.least)
        self.rows = materialise(sketches(docs, words, n_bands), "sketches")
        full = self.rows.filter("n_shingles > 0")
        self.nodes = materialise(full.groupBy("node").agg(
            F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.max("bands").alias("bands"),
            *(F.max(c).alias(c) for c in SKETCH_COLUMNS)), "nodes")
        members = self.nodes.select("node", F.explode("bands").alias("band"))
        crowd = members.groupBy("band").agg(F.count("*").alias("k")).filter("k > 1")
        self.crowded = materialise(members.join(crowd, "band"), "buckets")
        degree = self.crowded.groupBy("node").agg(F.floor(4 * F.log2(F.sum("k"))).alias("degree"),
                                                  F.sort_array(F.collect_set("band")).alias("own_bands"))
        self.light = materialise(self.nodes.join(degree, "node")
                                 .select("node", "rep", "n", "degree", "own_bands", *SKETCH_COLUMNS), "bucket_nodes")
        self.sets = materialise(self.shingle_sets(), "sets")

    def shingle_sets(self) -> DataFrame:
        """(node, sorted shingle hashes as bytes) of every node in a bucket, recomputed from one of its texts."""
        words = self.words

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, texts in slices(batches, SLICE):
                h, first = distinct_shingles(texts, words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(identities(h, first)),
                     pa.array([h[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())],
                    names=["node", "shingles"])

        wanted = self.light.select("rep").distinct().hint("merge")  # grows with the table: shuffled at every size
        texts = self.docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi")
        return texts.mapInArrow(run, "node long, shingles binary").filter("node != 0").dropDuplicates(["node"])

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) of nodes whose sizes, sketches and full sets have the similarity."""
        percent = self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = []
                for x, y in zip(batch.column(2), batch.column(3)):
                    p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                    if len(p) > len(q):
                        p, q = q, p
                    at = np.searchsorted(q, p)
                    both = int((q[np.minimum(at, len(q) - 1)] == p).sum())
                    good.append(100 * both >= percent * (len(p) + len(q) - both))
                yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

        sized = F.least("a.n", "b.n") * 100 >= F.greatest("a.n", "b.n") * percent
        able = (pairs.alias("p").join(self.light.alias("a"), F.col("p.a") == F.col("a.node"))
                .join(self.light.alias("b"), F.col("p.b") == F.col("b.node")).filter(sized & self.possible)
                .select(F.col("p.a").alias("a"), F.col("p.b").alias("b")))
        able = materialise(able, "able")
        x = self.sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
        y = self.sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
        with_sets = able.join(y, "b").join(x, "a").select("a", "b", "x", "y")
        return with_sets.mapInArrow(run, "a long, b long")

    def labelled(self, labels: DataFrame) -> DataFrame:
        """Bucket members with their present component, a node without links being its own."""
        return (self.crowded.join(labels, "node", "left")
                .withColumn("label", F.coalesce("label", "node")))

    def hub_pairs(self, members: DataFrame, turn: int) -> DataFrame:
        """(hub, node) for all nodes of each bucket that are not in the hub's component yet."""
        order = F.struct("degree", F.xxhash64("node", F.lit(turn)).alias("pick"), "node", "label")
        hubs = (members.groupBy("band").agg(F.max(order).alias("h"))
                .select("band", F.col("h.node").alias("hub"), F.col("h.label").alias("hub_label")))
        return (members.join(hubs, "band").filter("label != hub_label")
                .select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct())

    def mixed(self, members: DataFrame) -> DataFrame:
        """Members of buckets that still hold several components."""
        several = (members.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
                   .filter("lo != hi").select("band"))
        return members.join(several, "band", "left_semi")

    def labels(self) -> DataFrame:
        """(node, label) of every linked node."""
        spark = self.docs.sparkSession
        none = spark.createDataFrame([], "node long, label long")
        edges, labels, tried = None, none, None
        for turn in range(3):
            members = materialise(self.mixed(self.labelled(labels)), "mixed")
            if turn < 2:
                pairs = self.hub_pairs(members.join(self.light.select("node", "degree"), "node"), turn)
            else:
                data = members.join(self.light, "node")
                # a pair is told by the first bucket it shares only
                first = F.element_at(F.array_intersect("a.own_bands", "b.own_bands"), 1) == F.col("a.band")
                pairs = (data.alias("a").join(data.alias("b"), (F.col("a.band") == F.col("b.band"))
                                              & (F.col("a.node") < F.col("b.node"))
                                              & (F.col("a.label") != F.col("b.label")) & self.possible
                                              & (F.least("a.n", "b.n") * 100 >= F.greatest("a.n", "b.n") * self.percent) & first)
                         .select(F.col("a.node").alias("a"), F.col("b.node").alias("b")))
            if tried is not None:
                pairs = pairs.join(tried, ["a", "b"], "left_anti")
            pairs = materialise(pairs, "pairs")
            found = materialise(self.confirmed(pairs), "links")
            tried = pairs if tried is None else tried.union(pairs)
            edges = found if edges is None else edges.union(found)
            if turn == 2 or found.limit(1).count():
                labels = components(edges)
        return labels

    def linked(self) -> DataFrame:
        """(node, rep, label) of every node, one without links being its own component."""
        linked = self.nodes.select("node", "rep").join(self.labels(), "node", "left")
        return linked.withColumn("label", F.coalesce("label", "node"))

    def classes(self) -> DataFrame:
        """(doc_id, n_shingles, component_id, kept) of every row."""
        linked = self.linked()
        least = linked.groupBy("label").agg(F.min("rep").alias("component_id"))
        of_node = materialise(linked.join(least, "label").select("node", "component_id"), "classes")
        rows = self.rows.select("doc_id", "n_shingles", "node").join(of_node, "node", "left")
        component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        return (rows.select("doc_id", "n_shingles", component.alias("component_id"))
                .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def near_duplicates(df: DataFrame, words: int = 5, similarity: float = 0.8, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Component and verdict of every row; ``kept`` is true for one document of each component."""
    return NearDuplicates(two_columns(df, key, text), words, similarity).classes()


def without_near_duplicates(df: DataFrame, words: int = 5, similarity: float = 0.8, key: str = "doc_id",
                            text: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, one for each component; rows without words all stay.

    Rows are matched by id and text, nulls included. The row with the least id,
    one without an id coming last, stands for its component, then the one with
    the least ``xxhash64`` of its text, then of its whole row as JSON.
    """
    found = NearDuplicates(two_columns(df, key, text), words, similarity)
    rows = found.rows.filter("n_shingles > 0").groupBy("doc_id", "text_hash", "node").agg(F.count("*").alias("n"))
    rows = materialise(rows.join(found.linked().select("node", "label"), "node"), "component_rows")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "n"))
    best = materialise(rows.groupBy("label").agg(best.alias("best")).select("best.doc_id", "best.text_hash", "best.n"),
                       "component_bests")

    def same(own: DataFrame) -> Column:
        return (df[key].cast("long").eqNullSafe(own["own_id"])
                & (F.xxhash64(df[text].cast("string")) == own["own_hash"]))

    def named(own: DataFrame) -> DataFrame:
        return own.select(F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash"))

    other = rows.join(named(best), F.col("doc_id").eqNullSafe(F.col("own_id"))
                      & (F.col("text_hash") == F.col("own_hash")), "left_anti")
    again = materialise(best.filter("n > 1"), "repeated_bests")
    out = named(other.select("doc_id", "text_hash").union(again.select("doc_id", "text_hash")))
    kept = df.join(out, same(out), "left_anti")
    if not again.limit(1).count():
        return kept
    own = checked_broadcast(named(again))
    row = F.struct(*(df[c] for c in df.columns))
    one = (df.join(own, same(own)).groupBy("own_id", "own_hash")
           .agg(F.min_by(row, F.xxhash64(F.to_json(row))).alias("row")))
    return kept.unionByName(one.select("row.*"))
