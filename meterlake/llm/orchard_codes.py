"""Product codes of vectors; the nearest codebook entry is found by Orchard's search.

A vector is cut into equal consecutive parts, each part position has its own
codebook, and a vector's code names the nearest entry of each. Codebooks start
as given vectors and are improved in rounds of assigning and averaging. All
arithmetic is on integers (components times ``SCALE``, rounded down), so
results do not depend on the order of rows or tasks.

Orchard's search keeps, for every entry, the list of all entries in ascending
distance from it. A query walks the list of its best entry so far, skips the
entries it has marked as visited, jumps to the list of an entry that improves
on the best, and stops where the list is beyond twice the best distance: by
the triangle inequality no entry further out can be as near. Queries of a
batch walk in step, ``STEP`` list places at a time.

Rounds are Spark jobs: tasks assign their rows and send one row of sums per
part and entry; only the codebooks (``entries`` x width integers) are on the driver.

Defined results: rows whose vector is null or holds a null, NaN or infinite
component are dropped. Vectors whose width is not the commonest one (ties: the
lesser) are dropped too, as parts would not match; a width that the parts do not
divide is filled up with zeros. Integer components are held within a bound
at which squared distances of the width still fit 64 bits (2**28 at 64
components). Null ids come last in the order of the first codebook, equal ids
are ordered by their components; repeated rows count and are returned each; with fewer rows than
entries the codebook has as many entries as rows; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import materialise
from meterlake.llm.skew import spread_join

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
STEP = 64
PIVOTS = 32
BATCH = 1024
FAR = 2**62


class Orchard:
    """Nearest entries of one codebook (entries x components, integers), ties to the lower index."""

    def __init__(self, entries: np.ndarray):
        self.entries, count = entries, len(entries)
        gaps = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        lists = np.argsort(gaps, axis=1, kind="stable")
        pad = -count % STEP
        # filled up with an entry that no walk comes to
        self.lists = np.pad(lists, ((0, 0), (0, pad)), constant_values=count if pad else 0)
        self.gaps = np.pad(np.take_along_axis(gaps, lists, axis=1).astype(np.float64), ((0, 0), (0, pad)),
                           constant_values=np.inf)
        self.norms = np.append((entries**2).sum(axis=1), 0)
        self.pivots = np.unique(np.linspace(0, count - 1, min(PIVOTS, count)).astype(np.int64))

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of every point, by walks in step."""
        # products of integers below 2**24 (2**53) are exact in 32-bit (64-bit) floats
        widest = points.shape[1] * int(np.abs(points).max(initial=0)) * int(np.abs(self.entries).max(initial=0))
        kind = np.float32 if widest < 2**24 else np.float64 if widest < 2**53 else np.int64
        entries, own = np.vstack([self.entries, self.entries[:1]]).astype(kind), points.astype(kind)
        norm = (points**2).sum(axis=1)
        found = self.norms[self.pivots] - 2 * (own @ entries[self.pivots].T).astype(np.int64)
        first = found.argmin(axis=1)
        best, gap = self.pivots[first], norm + found[np.arange(len(points)), first]
        visited = np.zeros((len(points), self.lists.shape[1]), bool)
        visited[:, self.pivots] = True
        flags, size, lists, gaps = visited.reshape(-1), self.lists.shape[1], self.lists.reshape(-1), self.gaps.reshape(-1)
        live, place, steps = np.arange(len(points)), np.zeros(len(points), np.int64), np.arange(STEP)
        while len(live):
            here, nearest = best[live], gap[live]
            at = (here * size + place[live])[:, None] + steps
            ids, within = lists.take(at), gaps.take(at) <= 4.0 * nearest[:, None]
            marks = (live * size)[:, None] + ids
            fresh = within & ~flags.take(marks)
            flags[marks[fresh]] = True
            product = np.matmul(entries.take(ids, axis=0), own[live][:, :, None])[:, :, 0]
            found = np.where(fresh, self.norms.take(ids) - 2 * product.astype(np.int64), FAR)
            column = found.argmin(axis=1)
            least = found[np.arange(len(live)), column]
            entry = np.where(found == least[:, None], ids, size).min(axis=1)
            least = np.where(least == FAR, FAR, least + norm[live])
            better = (least < nearest) | ((least == nearest) & (entry < here))
            who = live[better]
            best[who], gap[who] = entry[better], least[better]
            place[live] = np.where(better, 0, place[live] + STEP)
            live = live[better | (within[:, -1] & (place[live] < size))]
        return best, gap


def component_bound(width: int) -> int:
    """Largest absolute integer component at which squared distances over the width fit 62 bits."""
    return math.isqrt(2**62 // max(width, 1)) // 2


def integer_vectors(vectors: DataFrame, parts: int) -> tuple[DataFrame, int]:
    """(vec_id, label, comps) of the kept rows as a written table, and the width of comps."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label",
                          F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("v").isNotNull() & F.coalesce(finite, F.lit(False)))
    common = rows.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), "width").first()
    width = common["width"] if common else 0
    padded = -(-width // parts) * parts
    bound = float(component_bound(padded))
    whole = F.transform("v", lambda x: F.least(F.greatest(F.floor(F.least(F.greatest(x * SCALE, F.lit(-bound)), F.lit(bound))),
                                                          F.lit(-int(bound))), F.lit(int(bound))).cast("int"))
    if padded > width:
        whole = F.concat(whole, F.array_repeat(F.lit(0), padded - width))
    return materialise(rows.filter(F.size("v") == width).select("vec_id", "label", whole.alias("comps")), "vectors"), padded


def points_of(comps: pa.Array, width: int) -> np.ndarray:
    return comps.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(comps), width)


def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, BATCH):
            yield batch.slice(first, BATCH)


def entry_sums(rows: DataFrame, books: np.ndarray) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """(count, component sums) by (part, entry) of the rows assigned to it."""
    parts, entries, length = books.shape
    names = [f"s{i}" for i in range(length)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Orchard(book) for book in books]
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, length), np.int64)
        for batch in batches_of(batches):
            points = points_of(batch.column(0), parts * length).reshape(batch.num_rows, parts, length)
            for part in range(parts):
                own = np.ascontiguousarray(points[:, part])
                entry, _ = search[part].nearest(own)
                order = np.argsort(entry, kind="stable")
                used, first = np.unique(entry[order], return_index=True)
                counts[part, used] += np.diff(first, append=len(order))
                if length:
                    sums[part, used] += np.add.reduceat(own[order], first, axis=0)
        part, entry = np.nonzero(counts)
        if len(part):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(entry), pa.array(counts[part, entry]),
                 *(pa.array(sums[part, entry, i]) for i in range(length))], names=["part", "entry", "n", *names])

    schema = "part long, entry long, n long" + "".join(f", {x} long" for x in names)
    # one row of each task, part and entry meets here; at most parts x entries rows reach the driver
    found = (rows.select("comps").mapInArrow(run, schema).groupBy("part", "entry")
             .agg(*(F.sum(x).alias(x) for x in ["n", *names])).collect())
    return {(r["part"], r["entry"]): (r["n"], [r[x] for x in names]) for r in found}


def trained_books(rows: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES,
                  rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts x entries x components) after the rounds; entries without rows keep their values."""
    least = rows.orderBy(F.col("vec_id").asc_nulls_last(), "comps").select("comps").limit(entries).collect()
    start = np.array([r["comps"] for r in least], np.int64).reshape(len(least), parts, width // parts)
    books = np.ascontiguousarray(start.transpose(1, 0, 2))
    for _ in range(rounds):
        for (part, entry), (n, sums) in entry_sums(rows, books).items():
            books[part, entry] = np.array(sums, np.int64) // n
    return books


def coded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every row: two hex digits a part, and the squared distance to the coded vector."""
    parts, _, length = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Orchard(book) for book in books]
        for batch in batches_of(batches):
            points = points_of(batch.column(2), parts * length).reshape(batch.num_rows, parts, length)
            found = [search[part].nearest(np.ascontiguousarray(points[:, part])) for part in range(parts)]
            codes = np.stack([entry for entry, _ in found], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([bytes(c).hex() for c in codes], pa.string()),
                 pa.array(np.sum([gap for _, gap in found], axis=0, dtype=np.int64))],
                names=["vec_id", "label", "code", "error"])

    kind = rows.schema["label"].dataType.simpleString()
    return rows.select("vec_id", "label", "comps").mapInArrow(run, f"vec_id long, label {kind}, code string, error long")


def codebook_text(books: np.ndarray) -> str:
    return ",".join(map(str, books.reshape(-1).tolist()))


def product_codes(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error (errors summed over equal labels, nulls together), codebooks_sha256."""
    rows, width = integer_vectors(vectors, PARTS)
    spark = rows.sparkSession
    if not rows.limit(1).count():
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    books = trained_books(rows, width)
    digest = hashlib.sha256(codebook_text(books).encode()).hexdigest()
    # a label as a key without nulls
    label = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))
    codes = materialise(coded(rows, books).select("vec_id", "code", "error", label.alias("label")), "codes")
    by_label = materialise(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    return spread_join(codes, by_label, ["label"]).select("vec_id", "code", "error", "label_error",
                                                          F.lit(digest).alias("codebooks_sha256"))
