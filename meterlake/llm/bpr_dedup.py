"""Repeated byte strings across a corpus, by bucket-pointer refinement.

Every byte that lies in a string of ``LENGTH`` bytes found at another place too
is removed. To sort only what can repeat, each such string (a window) is put
under the rarest-looking q-gram in it, the one of least hash; neighbouring
windows under the same gram form a piece. Equal windows have equal grams at
equal places, so they meet in one group, and a gram found once in the corpus
needs no further look. Pieces are counted by identity, so a piece found twice
is repeated as a whole, however many copies there are.

The different pieces of a group are then compared window by window, by
bucket-pointer refinement: all their positions start in buckets by their first
8 bytes; each round sorts the positions of buckets with several members by
(own bucket, bucket of the position further on), which doubles the depth, and
the refined buckets are the keys of the next round. At depth ``LENGTH`` windows
in one bucket are equal. Groups are packed into blocks of about
``BLOCK_BYTES``. A group with over ``HOT_PIECES`` different pieces, say around
a line that a third of all documents share, is compared by counting its
windows' hashes instead, which pre-aggregates and spreads over all tasks.

Defined results: a null or empty text, or one shorter than a window, loses
nothing; strings never cross documents; a repeated row is another place for
each of its strings, so both copies lose them; rows with null ids are treated
like others; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import gather_ragged, materialise, mix, slices, two_columns

LENGTH = 200
GRAM = 32
HOT_PIECES = 2_000
BLOCK_BYTES = 1 << 20
SLICE = 1 << 19  # text bytes cut into pieces at once: each takes about a hundred bytes of arrays
BASE = 0x9E3779B97F4A7C15 | 1

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def powers(n: int, base: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.ones(max(n, 1), np.uint64)
    done, step = 1, base
    while done < n:
        more = min(done, n - done)
        out[done:done + more] = out[:more] * np.uint64(step)
        done, step = done + more, step * step % (1 << 64)
    return out


class RangeHash:
    """Hashes of any byte ranges of a buffer from one prefix sum (a polynomial modulo 2 ** 64, then scrambled)."""

    def __init__(self, data: np.ndarray):
        with np.errstate(over="ignore"):
            up = powers(len(data) + 1, BASE)
            self.down = powers(len(data) + 1, pow(BASE, -1, 1 << 64))
            self.sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], dtype=np.uint64, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[end] - self.sums[start]) * self.down[start])


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours, by running minima of blocks from both sides."""
    n = len(values) - width + 1
    full = -(-len(values) // width) * width
    blocks = np.full(full, np.iinfo(np.uint64).max, np.uint64)
    blocks[:len(values)] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def pieces(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(document, first window, windows, gram hash, piece identity) of every piece of concatenated documents."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    hashes = RangeHash(data)
    at = np.arange(len(data) - gram + 1)
    grams = hashes.of(at, at + gram)
    place = np.uint64((1 << 24) - 1)
    width = length - gram + 1
    parts = []
    # positions are told apart inside stretches of 2 ** 23 windows; the high 40 bits order the grams
    for a in range(0, len(data) - length + 1, 1 << 23):
        b = min(a + (1 << 23), len(data) - length + 1)
        local = np.arange(b - a + width - 1, dtype=np.uint64)
        least = window_minima(grams[a:b + width - 1] & ~place | local, width)
        parts.append((least & place).astype(np.int64) + a)
    chosen = np.concatenate(parts)
    windows = np.maximum(np.diff(bounds) - length + 1, 0)
    start = gather_ragged(bounds[:-1], windows)
    doc = np.repeat(np.arange(len(windows)), windows)
    chosen = chosen[start]
    head = np.flatnonzero(np.append(True, (chosen[1:] != chosen[:-1]) | (doc[1:] != doc[:-1]))) if len(start) else none
    count = np.diff(np.append(head, len(start)))
    first, anchor = start[head], chosen[head]
    with np.errstate(over="ignore"):
        identity = mix(hashes.of(first, first + count + length - 1) * np.uint64(3)
                       + (anchor - first).astype(np.uint64) * np.uint64(0x100000001) + count.astype(np.uint64))
    return doc[head], first, count, grams[anchor], identity


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each begins."""
    texts = texts.cast(pa.binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def run_starts(new: np.ndarray) -> np.ndarray:
    """For every place the last one up to it where a run begins."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def refined_buckets(data: np.ndarray, valid: np.ndarray, length: int) -> np.ndarray:
    """Bucket of every position: positions in ``valid`` share one only if their next ``length`` bytes are equal.

    A bucket's pointer is the place of its first member in sorted order, so
    splitting a bucket moves no other one. Depth 8 comes from the bytes; a
    round at depth h sorts the positions whose bucket has several members by
    their own bucket and the one h further on (less at the last round).
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((n,), "<u8", buffer=padded, strides=(1,))
    order = np.argsort(eight)
    ordered = eight[order]
    bucket = np.empty(n, np.int64)
    bucket[order] = run_starts(np.append(True, ordered[1:] != ordered[:-1]))
    depth = min(8, length)
    while depth < length:
        step = min(depth, length - depth)
        moving = np.flatnonzero(np.bincount(bucket, minlength=n)[bucket] > 1)
        if not len(moving):
            break
        further = moving + step
        key = bucket[moving] * np.int64(n + 1) + np.where(further < n, bucket[np.minimum(further, n - 1)], n)
        order = np.argsort(key)
        key, moving = key[order], moving[order]
        own = bucket[moving]
        part = run_starts(np.append(True, key[1:] != key[:-1]))
        bucket[moving] = own + part - run_starts(np.append(True, own[1:] != own[:-1]))
        depth += step
    return bucket[valid]


def ranges(flags: np.ndarray) -> list[int]:
    """[start, end, start, end, ...] of the runs of true flags."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge.tolist()


def repeated_in_block(texts: list[bytes], times: np.ndarray, length: int = LENGTH) -> list[list[int]]:
    """Per piece, the runs of its windows that are also found elsewhere in the block (or in a copy of the piece)."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(size) - size
    windows = size - length + 1
    at = gather_ragged(first, windows)
    owner = np.repeat(np.arange(len(texts)), windows)
    bucket = refined_buckets(data, at, length)
    total = np.bincount(bucket, weights=times[owner])
    flag = total[bucket] > 1
    ends = np.cumsum(windows)
    return [ranges(flag[e - w:e]) for e, w in zip(ends, windows)]


class RepeatedStrings:
    """Spans of repeated strings of a document table."""

    def __init__(self, docs: DataFrame, length: int = LENGTH, hot_pieces: int = HOT_PIECES):
        self.length, self.hot_pieces = length, hot_pieces
        self.docs = docs.withColumn("row", F.xxhash64(F.col("doc_id"), F.col("text")))

    def all_pieces(self) -> DataFrame:
        """(row, gram, piece, n): how often each piece is found in each document."""
        length = self.length

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, texts in slices(batches, SLICE):
                data, bounds = buffer_of(texts)
                doc, _, _, gram, piece = pieces(data, bounds, length)
                order = np.lexsort((piece, doc))
                doc, gram, piece = doc[order], gram[order], piece[order]
                new = np.flatnonzero(np.append(True, (piece[1:] != piece[:-1]) | (doc[1:] != doc[:-1]))
                                     ) if len(doc) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [rows.take(pa.array(doc[new])), pa.array(gram[new].view(np.int64)),
                     pa.array(piece[new].view(np.int64)), pa.array(np.diff(np.append(new, len(doc))))],
                    names=["row", "gram", "piece", "n"])

        return self.docs.select("row", "text").mapInArrow(run, "row long, gram long, piece long, n long")

    def piece_texts(self, wanted: DataFrame) -> DataFrame:
        """(gram, piece, n, hot, text) of the wanted pieces (row, gram, piece, n, hot), cut from their documents."""
        length = self.length
        lists = wanted.groupBy("row").agg(F.collect_list(F.struct("gram", "piece", "n", "hot")).alias("wanted"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, texts, wanted_lists in slices(batches, SLICE):
                data, bounds = buffer_of(texts)
                doc, first, count, _, piece = pieces(data, bounds, length)
                ask = [{w["piece"]: w for w in x} for x in wanted_lists.to_pylist()]
                out = []
                for d, a, k, p in zip(doc.tolist(), first.tolist(), count.tolist(), piece.view(np.int64).tolist()):
                    w = ask[d].pop(p, None)
                    if w is not None:
                        out.append({**w, "text": data[a:a + k + length - 1].tobytes()})
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                    [("gram", pa.int64()), ("piece", pa.int64()), ("n", pa.int64()), ("hot", pa.bool_()),
                     ("text", pa.binary())]))

        return (self.docs.join(lists, "row").select("row", "text", "wanted")
                .mapInArrow(run, "gram long, piece long, n long, hot boolean, text binary"))

    def by_refinement(self, texts: DataFrame) -> DataFrame:
        """(piece, spans) of groups small enough for a block."""
        length = self.length
        total = texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("b")).first()["b"]
        n_blocks = max(1, -(-int(total) // BLOCK_BYTES))

        def run(block: pa.Table) -> pa.Table:
            spans = repeated_in_block([x.as_py() for x in block["text"]], block["n"].to_numpy(), length)
            return pa.table({"piece": block["piece"], "spans": pa.array(spans, pa.list_(pa.int32()))})

        return (texts.withColumn("block", F.pmod(F.xxhash64("gram"), F.lit(n_blocks))).groupBy("block")
                .applyInArrow(run, "piece long, spans array<int>"))

    def by_counting(self, texts: DataFrame) -> DataFrame:
        """(piece, spans) of the windows of very large groups, counted by hash over all tasks.

        The windows travel as arrays, one row for each part of the hash range
        and 512 pieces; the number of parts follows the bytes, so no part and
        no task holds a whole group.
        """
        length = self.length
        total = texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("b")).first()["b"]
        n_parts = max(1, -(-int(total) // BLOCK_BYTES))

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(0, batch.num_rows, 512):
                    piece, text, n = (batch.column(c).slice(k, 512) for c in range(3))
                    data, bounds = buffer_of(text)
                    windows = np.diff(bounds) - length + 1
                    at = gather_ragged(bounds[:-1], windows)
                    place = (np.arange(len(at)) - np.repeat(np.cumsum(windows) - windows, windows)).astype(np.int32)
                    owner = np.repeat(np.arange(len(windows)), windows)
                    window = RangeHash(data).of(at, at + length)
                    part = (window % np.uint64(n_parts)).astype(np.int64)
                    order = np.argsort(part, kind="stable")
                    cuts = np.searchsorted(part[order], np.arange(n_parts + 1))
                    piece, n = (c.to_numpy(zero_copy_only=False) for c in (piece, n))
                    rows = [(p, order[a:b]) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p for p, _ in rows], pa.int64()),
                         *(pa.array([x[o].tobytes() for _, o in rows], pa.binary())
                           for x in (window, n[owner], piece[owner], place))],
                        names=["part", "window", "n", "piece", "place"])

        def count(sent: pa.Table) -> pa.Table:
            window, n, piece, place = (np.concatenate([np.frombuffer(x.as_py(), t) for x in sent[c]]) for c, t in
                                       (("window", np.uint64), ("n", np.int64), ("piece", np.int64), ("place", np.int32)))
            _, back = np.unique(window, return_inverse=True)
            twice = np.flatnonzero(np.bincount(back, weights=n)[back] > 1)
            twice = twice[np.argsort(piece[twice], kind="stable")]
            owner, first = np.unique(piece[twice], return_index=True)
            places = pa.ListArray.from_arrays(pa.array(np.append(first, len(twice)), pa.int32()),
                                              pa.array(place[twice]))
            return pa.table({"piece": pa.array(owner, pa.int64()), "places": places})

        def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                spans = []
                for x in batch.column(1):
                    flags = np.zeros(max(x.as_py()) + 1, bool)
                    flags[x.as_py()] = True
                    spans.append(ranges(flags))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(pa.int32()))],
                                                 names=["piece", "spans"])

        sent = texts.select("piece", "text", "n").mapInArrow(
            send, "part long, window binary, n binary, piece binary, place binary")
        places = (sent.groupBy("part").applyInArrow(count, "piece long, places array<int>")
                  .groupBy("piece").agg(F.flatten(F.collect_list("places")).alias("places")))
        return places.mapInArrow(runs, "piece long, spans array<int>")

    def repeated(self) -> DataFrame:
        """(row, found): each document's pieces with repeated windows; null spans stand for all of them."""
        every = materialise(self.all_pieces(), "pieces")
        shared = every.groupBy("gram").agg(F.sum("n").alias("times")).filter("times > 1").select("gram")
        some = materialise(every.join(shared, "gram", "left_semi"), "shared_pieces")
        distinct = materialise(some.groupBy("gram", "piece").agg(F.sum("n").alias("n"), F.min("row").alias("row")),
                               "distinct_pieces")
        several = distinct.groupBy("gram").agg(F.count("*").alias("d"), F.min("n").alias("least")).filter(
            "d > 1 and least = 1").select("gram", (F.col("d") > self.hot_pieces).alias("hot"))
        texts = materialise(self.piece_texts(distinct.join(several, "gram")), "piece_texts")
        spans = self.by_refinement(texts.filter("not hot")).union(self.by_counting(texts.filter("hot")))
        whole = distinct.filter("n > 1").select("piece", F.lit(None).cast("array<int>").alias("spans"))
        part = (spans.filter(F.size("spans") > 0)
                .join(distinct.filter("n = 1").select("piece"), "piece", "left_semi"))
        found = materialise(whole.union(part), "repeated_pieces")
        return (some.select("row", "piece").distinct().join(found, "piece").groupBy("row")
                .agg(F.collect_list(F.struct("piece", "spans")).alias("found")))

    def removed(self) -> DataFrame:
        """Per row of the table, what is left when every repeated byte is removed."""
        length = self.length

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for keys, texts, found in slices(batches, SLICE):
                data, bounds = buffer_of(texts)
                lists = found.to_pylist()
                gone = np.zeros(len(data) + 1, np.int64)
                if any(x for x in lists):
                    doc, first, count, _, piece = pieces(data, bounds, length)
                    ask = [{w["piece"]: w["spans"] for w in x} if x else None for x in lists]
                    for d, a, k, p in zip(doc.tolist(), first.tolist(), count.tolist(), piece.view(np.int64).tolist()):
                        if ask[d] is not None and p in ask[d]:
                            spans = ask[d][p]
                            spans = [0, k] if spans is None else spans
                            for s, e in zip(spans[::2], spans[1::2]):
                                gone[a + s] += 1
                                gone[a + e - 1 + length] -= 1
                flag = np.cumsum(gone)[:-1] > 0
                removed, spans, digests = [], [], []
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    own = flag[a:b]
                    removed.append(int(own.sum()))
                    spans.append(int(own[0] + (own[1:] & ~own[:-1]).sum()) if b > a else 0)
                    digests.append(hashlib.sha256(data[a:b][~own].tobytes()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(np.diff(bounds)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                     pa.array(digests, pa.string())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

        return (self.docs.join(self.repeated(), "row", "left").select("doc_id", "text", "found")
                .mapInArrow(run, RESULT))


def without_repeated_strings(df: DataFrame, length: int = LENGTH, hot_pieces: int = HOT_PIECES, key: str = "doc_id",
                             text: str = "text") -> DataFrame:
    """Sizes and digest of every whole text after the removal of its repeated strings."""
    return RepeatedStrings(two_columns(df, key, text), length, hot_pieces).removed()
