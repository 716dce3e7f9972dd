"""Shards of documents by balanced label propagation.

Documents are linked through groups (here: equal texts). Every linked document
has a label, its shard; in each round it wishes for the shard that holds most of
its groups' members, and wishes are granted under capacity quotas. A group's
members are counted per shard, so a group of any size is one row of counts,
never pairs. The members of a group agree on how ties are broken, so a round
cannot swap them past each other.

Quotas: the wished bytes between any two shards are granted in full, then taken back from
shards that would end above the capacity (the mean size of a shard) until none
does. Between two shards the documents with the strongest pull go first. The
first rounds only admit strong pulls, so small groups gather before large ones
fill whole shards; a shard that had to refuse wishes later on counts as full and is no longer wished for, so a
group that is larger than a shard fills one after another.

Documents without links carry no cut edge: they are held back and dealt last, large
ones first, so that every shard's bytes come out near the mean. Documents of shards that
propagation left too full are dealt anew with them, group by group.

Only counts per shard, per pair of shards and per cell (a bounded number of classes
and buckets) reach the driver. Slots are numbered in buckets whose offsets
are running sums, so no task orders a whole shard.

Defined results: a null text has no bytes and is as an empty one; empty texts are
equal to each other; documents with null or equal ids and repeated rows are placed each;
an empty table gives an empty result; other columns are ignored. Among rows that are alike, and
between buckets, places depend on the rows' order in the input files.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterlake.llm.common import materialise
from meterlake.llm.skew import hot_keys, spread_join

SHARDS = 8
# least share of a document's links that its target must hold, by round; the last goes on until nothing moves
PULLS = (0.5, 0.25, 0.0)
ROUNDS = 16
# room above the capacity while small groups gather; what is left above it in the end is dealt anew
SLACK = 0.1
UNIT = 1 << 20
CLASSES, CELLS = 16, 64
BUCKETS = 4096
SLOT_ROWS = 50_000


def granted(loads: np.ndarray, wishes: np.ndarray, capacity: float) -> np.ndarray:
    """Bytes that may move from shard i to j: all wishes, less what would put a shard above the capacity."""
    grant = wishes.astype(np.float64).copy()
    for _ in range(64 * len(loads)):
        after = loads + grant.sum(axis=0) - grant.sum(axis=1)
        over = np.where(grant.sum(axis=0) > 0, after - capacity, 0)
        if over.max() <= 1:
            break
        j = int(over.argmax())
        grant[:, j] *= max(0.0, 1 - over[j] / grant[:, j].sum())
    return np.floor(grant)


def propagate(linked: DataFrame, shards: int, capacity: float) -> DataFrame:
    """(row, size, link, mix, shard): labels of the ``linked`` rows (row, size, link, mix; a row once for each link)."""
    spark = linked.sparkSession
    links = materialise(linked.withColumn("shard", F.pmod(F.shiftright("mix", 8), F.lit(shards)).cast("int")), "labels")
    hot = hot_keys(links, ["link"])
    full = np.zeros(shards, bool)
    for number in range(ROUNDS):
        last = number >= len(PULLS) - 1
        room = capacity if last else capacity * (1 + SLACK)
        once = links.groupBy("row").agg(F.first("size").alias("size"), F.first("shard").alias("shard"))
        loads = np.zeros(shards)
        for r in once.groupBy("shard").agg(F.sum("size").alias("n")).collect():  # one row a shard
            loads[r["shard"]] = r["n"]
        members = materialise(links.groupBy("link").agg(
            F.count("*").alias("degree"),
            F.array(*(F.count(F.when(F.col("shard") == s, 1)) for s in range(shards))).alias("members")), "members")
        open_to = F.array(*(F.lit(bool(loads[s] < room and not full[s])) for s in range(shards)))
        # a link's pull towards a shard is the share of its members there, as an integer
        pulls = (spread_join(links, members, ["link"], hot=hot)
                 .select("row", "size", "mix", "shard", "link",
                         F.transform("members", lambda n: F.floor(n * UNIT / F.col("degree"))).alias("pull"))
                 .groupBy("row").agg(
                     F.first("size").alias("size"), F.first("mix").alias("mix"), F.first("shard").alias("shard"),
                     F.min("link").alias("voice"), F.count("*").alias("n_links"),
                     F.array(*(F.sum(F.col("pull")[s]) for s in range(shards))).alias("pull")))
        choices = F.transform("pull", lambda p, s: F.struct(
            ((s == F.col("shard")) | open_to[s]).alias("open"), p.alias("pull"), F.xxhash64("voice", s).alias("tie"), s.alias("to")))
        wishes = pulls.withColumn("best", F.array_max(choices)).select(
            "row", "size", "mix", "shard", F.col("best.to").alias("to"),
            (F.col("best.pull") / (F.col("n_links") * UNIT)).alias("share"))
        least = PULLS[min(number, len(PULLS) - 1)]
        wishes = wishes.filter((F.col("to") != F.col("shard")) & (F.col("share") >= least))
        wishes = materialise(wishes.select(
            "row", "size", "shard", "to", F.least(F.floor(F.col("share") * CLASSES), F.lit(CLASSES - 1)).cast("int").alias("class"),
            F.pmod(F.shiftright("mix", 16), F.lit(CELLS)).cast("int").alias("cell")), "wishes")
        asked = np.zeros((shards, shards))
        for r in wishes.groupBy("shard", "to").agg(F.sum("size").alias("n")).collect():  # one row a pair of shards
            asked[r["shard"], r["to"]] = r["n"]
        if last and not asked.any():
            break
        grant = granted(loads, asked, room)
        full |= last & (grant < asked).any(axis=0)
        if not grant.any():
            continue
        if (grant < asked).any():
            quota = spark.createDataFrame([(i, j, int(grant[i, j])) for i in range(shards) for j in range(shards)],
                                          "shard int, to int, quota long")
            upto = Window.partitionBy("shard", "to").orderBy(F.desc("class"), "cell")
            # at most shards**2 x classes x cells rows
            cells = (wishes.groupBy("shard", "to", "class", "cell").agg(F.sum("size").alias("n"))
                     .withColumn("upto", F.sum("n").over(upto)).join(F.broadcast(quota), ["shard", "to"])
                     .filter(F.col("upto") <= F.col("quota")).select("shard", "to", "class", "cell"))
            wishes = wishes.join(F.broadcast(cells), ["shard", "to", "class", "cell"])
        moved = links.join(wishes.select("row", "to"), "row", "left")
        links = materialise(moved.select("row", "size", "link", "mix", F.coalesce("to", "shard").alias("shard")), "labels")
    return links


def dealt(loose: DataFrame, loads: np.ndarray, capacity: float) -> DataFrame:
    """``loose`` (row, size, mix) with a shard each, such that the shards' loads come near the capacity.

    Three classes of size, large ones first; in each, buckets of rows go to shards in
    proportion to the room that is left. One row of bytes per class and bucket reaches the driver.
    """
    spark = loose.sparkSession
    middle = loose.agg(F.percentile_approx("size", [0.1, 0.5]).alias("q")).first()["q"] or [0, 0]
    kind = F.when(F.col("size") > middle[1], 0).when(F.col("size") > middle[0], 1).otherwise(2)
    loose = loose.withColumn("kind", kind).withColumn("bucket", F.pmod(F.shiftright("mix", 24), F.lit(BUCKETS)).cast("int"))
    held = np.zeros((3, BUCKETS))
    for r in loose.groupBy("kind", "bucket").agg(F.sum("size").alias("n")).collect():
        held[r["kind"], r["bucket"]] = r["n"]
    loads, places = loads.astype(np.float64).copy(), []
    for kind in range(3):
        room = np.maximum(capacity - loads, 0)
        ends = np.cumsum(room if room.any() else np.ones(len(loads)))
        at = (np.cumsum(held[kind]) - held[kind] / 2) * ends[-1] / max(held[kind].sum(), 1)
        shard = np.minimum(np.searchsorted(ends, at, side="right"), len(loads) - 1)
        np.add.at(loads, shard, held[kind])
        places += [(kind, b, int(s)) for b, s in enumerate(shard)]
    places = spark.createDataFrame(places, "kind int, bucket int, shard int")
    return loose.join(F.broadcast(places), ["kind", "bucket"]).drop("kind", "bucket")


def loosened(links: DataFrame, shards: int, capacity: float) -> DataFrame:
    """(row, size, mix, shard) once per linked row; the shard is null for what had to leave a shard above the capacity.

    The smallest groups leave first and whole; of a group larger than what is left to go, rows enough leave.
    """
    once = materialise(links.groupBy("row").agg(F.first("size").alias("size"), F.first("mix").alias("mix"),
                                                F.first("shard").alias("shard"), F.min("link").alias("link")), "placed")
    once = once.withColumn("bucket", F.pmod(F.xxhash64("link", F.lit(3)), F.lit(BUCKETS)).cast("int"))
    held = np.zeros((shards, BUCKETS))
    for r in once.groupBy("shard", "bucket").agg(F.sum("size").alias("n")).collect():  # shards x buckets rows
        held[r["shard"], r["bucket"]] = r["n"]
    out = []
    for s in range(shards):
        excess, order = held[s].sum() - capacity, np.argsort(held[s], kind="stable")
        for b in order[held[s][order] > 0]:
            if excess <= 0:
                break
            part = float(min(1.0, excess / held[s][b]))
            out.append((s, int(b), part))
            excess -= part * held[s][b]
    out = once.sparkSession.createDataFrame(out, "shard int, bucket int, part double")
    leaves = F.col("part").isNotNull() & (F.pmod(F.shiftright("mix", 8), F.lit(UNIT)) < F.col("part") * UNIT)
    together = F.when(F.col("part") == 1.0, F.xxhash64("link", F.lit(4))).otherwise(F.col("mix"))
    return once.join(F.broadcast(out), ["shard", "bucket"], "left").withColumn("leaves", leaves).select(
        "row", "size", F.when(F.col("leaves"), together).otherwise(F.col("mix")).alias("mix"),
        F.when(~F.col("leaves"), F.col("shard")).alias("shard"))


def balanced_labels(nodes: DataFrame, links: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(row, shard) of every node (row, size, mix), written; ``links`` (row, link) name the groups a node belongs to.

    ``row`` is unique; ``mix`` spreads rows evenly. A group of one links nothing.
    """
    capacity = (nodes.agg(F.sum("size")).first()[0] or 0) / shards
    links = materialise(links.distinct(), "links")
    groups = materialise(links.groupBy("link").agg(F.count("*").alias("degree")).filter("degree > 1").select("link"), "groups")
    linked = materialise(spread_join(links, groups, ["link"]), "linked")
    labels = propagate(linked.join(nodes, "row").select("row", "size", "link", "mix"), shards, capacity)
    placed = materialise(loosened(labels, shards, capacity), "placed")
    loads = np.zeros(shards)
    for r in placed.filter("shard is not null").groupBy("shard").agg(F.sum("size").alias("n")).collect():
        loads[r["shard"]] = r["n"]
    loose = nodes.join(placed, "row", "left_anti").select("row", "size", "mix").unionByName(
        placed.filter("shard is null").select("row", "size", "mix"))
    rest = dealt(materialise(loose, "loose"), loads, capacity)
    return materialise(placed.filter("shard is not null").select("row", "shard").unionByName(rest.select("row", "shard")), "shards")


def sharded_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document, linked by equal texts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # row ids are settled by writing them
    rows = materialise(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("link"),
        F.monotonically_increasing_id().alias("row")), "documents").withColumn("mix", F.xxhash64("row", "link"))
    labels = balanced_labels(rows.select("row", "size", "mix"), rows.select("row", "link"), shards)
    parts = max(1, -(-rows.count() // SLOT_ROWS))
    rows = materialise(rows.join(labels, "row").withColumn("part", F.pmod(F.shiftright("mix", 40), F.lit(parts))), "sharded")
    sizes = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    place = Window.partitionBy("shard", "part").orderBy("mix", "row")
    return (rows.withColumn("place", F.row_number().over(place)).join(offsets, ["shard", "part"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("first") + F.col("place") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
