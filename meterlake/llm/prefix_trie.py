"""Prefix trie of conversations, by collapsing whole sequences.

Conversations are rebuilt (a few turns of a shared opening, then their own),
identical rebuilt conversations are grouped into one weighted sequence with
the list of conversations that end there, and the trie's nodes are the weighted
prefixes of these sequences. A sequence that is a proper prefix of another is
found by an anti-join against all prefixes; the others are the leaves.

A prefix is known by its length and 128 bits: the exclusive or of two 64-bit
hashes of (position, role, text) over its turns. Running values along a conversation are
taken in range partitions of (conversation, position), so that a conversation
of any length is spread over tasks: values run inside a partition, and what came
before is added for the first conversation of each partition only, from a
broadcast table of at most one row a partition.

Sums over subtrees need no walk of the tree. With w a sequence's weight and
B(d) its bytes up to depth d, the sum of n_convs times bytes below a
node at depth d is the sum of w * (B(end) - B(d-1)) over the sequences through it;
and as every node belongs to one of its sequences (the one of its smallest
member) which owns a run of depths from a to its end or none, the sum of bytes
below it is the sum of B(end) - B(max(d, a) - 1) over the same sequences.

Defined results: rows without a conv_id belong to no conversation and are left out;
turns with equal numbers are ordered by role, then text (null: empty), repeated rows are turns
of their own; a conversation whose turns all fall away is a member of the root alone;
c % 5 has the sign of c; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.llm.common import materialise
from meterlake.llm.skew import spread_join

FAMILY = 5
OPENINGS = 9
KEY = ["depth", "h1", "h2"]
EMPTY_LIST = hashlib.sha256(b"").hexdigest()
PIECE_IDS = 8192


def running(rows: DataFrame, key: str, order: list[Column], measures: dict[str, tuple], name: str) -> DataFrame:
    """``rows`` with running values per ``key`` in ``order``, the present row included, as a written table.

    ``measures`` maps a new column to (aggregate, how two values combine, value
    column); the aggregate skips nulls, and a missing value counts as nothing. Range
    partitions split a key of any size; only the first key of a partition
    can have begun in an earlier one.
    """
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    spread = (rows.repartitionByRange(parts, F.col(key), order[0]).withColumn("_part", F.spark_partition_id()))
    here = Window.partitionBy("_part", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    spread = materialise(spread.select("*", *(agg(value).over(here).alias(new) for new, (agg, _, value) in measures.items())),
                         name)
    totals = spread.groupBy("_part", key).agg(*(agg(value).alias(f"_{new}") for new, (agg, _, value) in measures.items()))
    # keys that lie in more than one partition: one row for each partition border they cross
    split = totals.groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1").select(key)
    split = totals.join(split, key, "left_semi")
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = split.select("_part", key, *(agg(F.col(f"_{new}")).over(before).alias(f"_{new}")
                                           for new, (agg, _, _) in measures.items()))
    offsets = materialise(offsets, "offsets")
    joined = spread.join(F.broadcast(offsets), ["_part", key], "left")  # at most two rows a partition
    full = {new: F.when(F.col(f"_{new}").isNull(), F.col(new)).otherwise(both(F.col(new), F.col(f"_{new}")))
            for new, (_, both, _) in measures.items()}
    return joined.withColumns(full).drop("_part", *(f"_{new}" for new in measures))


def plus(a: Column, b: Column) -> Column:
    return a + b


def xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, h1, h2, bytes) of every rebuilt turn, and the distinct conv_ids, as written tables."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    turns = (conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                  role.alias("role"), text.alias("text"))
             .filter(F.col("conv_id").isNotNull()))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    spark = turns.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    # texts leave with the first shuffle: what is written holds their hashes
    spread = turns.repartitionByRange(parts, F.col("conv_id"), F.col("turn").asc_nulls_first()).withColumn(
        "_part", F.spark_partition_id())
    here = Window.partitionBy("_part", "conv_id").orderBy(*order)
    spread = materialise(spread.select("_part", "conv_id", F.row_number().over(here).cast("long").alias("own"),
                                       F.xxhash64("role", "text").alias("t1"),
                                       F.xxhash64("text", "role", F.lit(1)).alias("t2"),
                                       F.octet_length("text").cast("long").alias("bytes")), "turns")
    sizes = materialise(spread.groupBy("_part", "conv_id").agg(F.max("own").alias("n")), "turn-counts")
    before = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = materialise(sizes.select("_part", "conv_id", F.sum("n").over(before).alias("earlier"))
                          .filter("earlier is not null"), "offsets")  # at most one row a partition
    turns = (spread.join(F.broadcast(earlier), ["_part", "conv_id"], "left")
             .withColumn("own", F.col("own") + F.coalesce("earlier", F.lit(0))).drop("_part", "earlier"))

    ids = sizes.groupBy("conv_id").agg(F.sum("n").alias("n"))
    borrowed = F.crc32(F.col("conv_id").cast("string")) % OPENINGS
    convs = ids.select("conv_id", "n", borrowed.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
    heads = ids.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = materialise(convs.join(heads, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken")), "conversations")
    opening = turns.filter(F.col("own") < OPENINGS).select(F.col("conv_id").alias("base"), "own", "t1", "t2", "bytes")
    opening = (convs.filter("taken > 0").join(opening, "base").filter("own <= taken")
               .select("conv_id", F.col("own").alias("depth"), "t1", "t2", "bytes"))
    # h and taken of a conversation depend on its id and its base; both travel with its own turns
    turns = materialise(turns, "numbered-turns")
    rest = (spread_join(turns, convs.select("conv_id", "h", "taken"), ["conv_id"]).filter("own > h")
            .select("conv_id", (F.col("own") - F.col("h") + F.col("taken")).alias("depth"), "t1", "t2", "bytes"))
    both = opening.unionByName(rest).select("conv_id", "depth", F.xxhash64("depth", "t1", "t2").alias("e1"),
                                            F.xxhash64("t2", "t1", "depth", F.lit(1)).alias("e2"), "bytes")
    return materialise(both, "rebuilt"), convs.select("conv_id")


def end_digests(ends: DataFrame, workers: SparkSession | None = None) -> DataFrame:
    """(depth, h1, h2, ends_sha256) per whole sequence of ``ends`` (depth, h1, h2, conv_id).

    Sorted range partitions join ids into pieces of at most ``PIECE_IDS``; the pieces of
    a sequence then meet in one task, which feeds them to the hash one after another.
    """
    key_type = "depth long, h1 long, h2 long"

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            out: list[list] = [[], [], [], [], []]
            first = 0
            rows = list(zip(*columns[:3]))
            for at in range(1, len(rows) + 1):
                if at == len(rows) or rows[at] != rows[first] or at - first == PIECE_IDS:
                    for column, value in zip(out, (*rows[first], columns[3][first], ",".join(map(str, columns[3][first:at])))):
                        column.append(value)
                    first = at
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:4]), pa.array(out[4], pa.string())],
                                             names=[*KEY, "first_id", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            out: list[tuple] = []
            for depth, h1, h2, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (depth, h1, h2) != now:
                    if now is not None:
                        out.append((*now, state.hexdigest()))
                    now, state = (depth, h1, h2), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield told(out)
        if now is not None:
            yield told([(*now, state.hexdigest())])

    def told(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [[], [], [], []]
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
                                          names=[*KEY, "ends_sha256"])

    joined = (ends.select(*KEY, "conv_id").repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
              .mapInArrow(pieces, f"{key_type}, first_id long, ids string"))
    return (joined.repartition(*KEY).sortWithinPartitions(*KEY, "first_id").mapInArrow(digests, f"{key_type}, ends_sha256 string"))


def trie_nodes(conversations: DataFrame) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, ids = rebuilt(conversations)
    whole = turns.groupBy("conv_id").agg(F.count("*").alias("depth"), F.bit_xor("e1").alias("h1"), F.bit_xor("e2").alias("h2"),
                                         F.sum("bytes").alias("total"))
    zero = F.lit(0).cast("long")
    ends = materialise(ids.join(whole, "conv_id", "left").select(
        "conv_id", *(F.coalesce(c, zero).alias(c) for c in [*KEY, "total"])), "ends")

    # whole-sequence collapse: one weighted sequence for all conversations that are the same
    sequences = materialise(ends.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("weight"),
                                                   F.max("total").alias("total")), "sequences")
    facts = sequences.select("conv_id", "weight", F.col("depth").alias("end"), "total")
    steps = spread_join(turns, facts, ["conv_id"])
    prefixes = running(steps, "conv_id", [F.col("depth")],
                       {"h1": (F.bit_xor, xor, F.col("e1")), "h2": (F.bit_xor, xor, F.col("e2")),
                        "upto": (F.sum, plus, F.col("bytes"))}, "steps")
    prefixes = prefixes.select("conv_id", *KEY, F.col("h1").bitwiseXOR(F.col("e1")).alias("p1"),
                               F.col("h2").bitwiseXOR(F.col("e2")).alias("p2"), "bytes",
                               (F.col("upto") - F.col("bytes")).alias("before"), "weight", "end", "total")
    roots = facts.select("conv_id", zero.alias("depth"), zero.alias("h1"), zero.alias("h2"), zero.alias("p1"), zero.alias("p2"),
                         zero.alias("bytes"), zero.alias("before"), "weight", "end", "total")
    prefixes = materialise(prefixes.unionByName(roots), "prefixes")

    nodes = materialise(prefixes.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.first("p1").alias("p1"),
        F.first("p2").alias("p2"), F.first("before").alias("before")), "nodes")
    # a sequence that is a proper prefix of another is no leaf
    proper = prefixes.filter(F.col("depth") < F.col("end")).select(*KEY).distinct()
    leaves = sequences.join(proper, KEY, "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    owned = nodes.groupBy("conv_id").agg(F.min("depth").alias("owns"), F.min_by("before", "depth").alias("owns_before"))
    more = materialise(sequences.select("conv_id").join(owned, "conv_id", "left").join(leaves, "conv_id", "left"), "owners")
    below = F.when(F.col("owns").isNull(), zero).when(F.col("depth") >= F.col("owns"), F.col("total") - F.col("before")).otherwise(
        F.col("total") - F.col("owns_before"))
    sums = (spread_join(prefixes, more, ["conv_id"]).groupBy(*KEY).agg(
        F.sum(F.coalesce("leaf", zero)).alias("n_leaves"),
        F.sum(F.col("weight") * (F.col("total") - F.col("before")) - below).alias("saved_tokens")))

    inner = nodes.filter("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("h1"),
                                             F.col("p2").alias("h2"), F.struct(*KEY).alias("child"))
    inner = materialise(inner, "children")
    above = nodes.select(*KEY, F.col("conv_id").alias("parent_conv_id"))
    parents = spread_join(inner, above, KEY).select(*(F.col(f"child.{k}").alias(k) for k in KEY), "parent_conv_id")
    children = inner.groupBy(*KEY).agg(F.count("*").alias("n_children"))
    return (nodes.join(sums, KEY).join(children, KEY, "left").join(parents, KEY, "left").join(end_digests(ends), KEY, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
                    "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_LIST)).alias("ends_sha256")))
