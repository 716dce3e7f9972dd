"""Near-dedup, decontamination and the whole pipeline: null ids, repeated rows and two texts under one id."""

import random

import corpus_pipeline
from meterlake.llm import odd_sketch, seed_align
from tests.llm.test_operators import SCHEMA, prose


def row(i, t):
    return (i, t, "en", len(t), 7, "x", 1, 2, "l")


def two_tables():
    """(documents, item, the texts of each expected group, the texts with the item)."""
    rng = random.Random(11)
    t = [prose(rng, 80) for _ in range(12)]
    near = t[0].split(" ")
    near[40] = "changed"
    item = prose(rng, 30)
    leaked = [prose(rng, 40) + " " + item, item + " " + prose(rng, 60)]
    docs = [row(1, t[0]), row(None, t[0]), row(None, " ".join(near)),      # one group, the id-less copies go
            row(None, t[1]), row(None, t[2]), row(None, t[3]),             # id-less and unique
            row(None, t[4]), row(None, t[4]), row(None, t[4]),             # a group without any id
            row(5, t[5]), row(5, t[5]),                                    # a repeated row
            row(6, t[6]), row(6, t[7]), row(4, t[7]),                      # two texts under one id, one of them a copy
            row(None, leaked[0]), row(8, leaked[1]), row(8, t[8]), row(9, t[9])]
    groups = [{t[0], " ".join(near)}, *({x} for x in t[1:10]), *({x} for x in leaked)]
    return docs, item, groups, leaked


def test_one_row_of_each_group_stays(spark):
    docs, _, groups, _ = two_tables()
    got = odd_sketch.without_near_duplicates(spark.createDataFrame(docs, SCHEMA).repartition(3))
    rows = sorted((tuple(r) for r in got.collect()), key=repr)
    want = [min((d for d in docs if d[1] in g), key=lambda d: (d[0] is None, d[0] or 0)) for g in groups]
    assert got.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert rows == sorted(want, key=repr)


def test_only_texts_with_an_item_go(spark):
    docs, item, _, leaked = two_tables()
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = seed_align.without_leaks(spark.createDataFrame(docs, SCHEMA).repartition(3), items)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(
        (d for d in docs if d[1] not in leaked), key=repr)


def test_whole_pipeline(spark, tmp_path):
    docs, item, groups, leaked = two_tables()
    spark.createDataFrame(docs, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = {tuple(r) for r in corpus_pipeline.quality(spark, spark.createDataFrame(docs, SCHEMA), "").select(
        "doc_id", "text").collect()}
    left = [g for g in groups if not g & set(leaked) and any(d[:2] in kept for d in docs if d[1] in g)]
    got = corpus_pipeline.run(spark, str(tmp_path)).filter("start = 0").collect()
    want = [min((d[0] for d in docs if d[1] in g and d[:2] in kept), key=lambda i: (i is None, i or 0)) for g in left]
    assert sorted((r["doc_id"] for r in got), key=repr) == sorted(want, key=repr)
