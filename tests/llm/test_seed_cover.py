"""Every alignment of the share is found, whatever the words, the ids and the size of the corpus."""

import random

import numpy as np

from meterlake.llm import seed_align


def edited(rng, words, kind, common):
    """``words`` with so many edits that the score stays at half of the words or over."""
    out, left = list(words), len(words) // 2
    if kind == "insert":  # after every second word
        return [w for k, x in enumerate(words) for w in ([x, "zzz"] if k % 2 and k < len(words) - 1 else [x])]
    for k in range(3, len(words), 5):
        if left >= 2:
            out[k] = "" if kind == "drop" else rng.choice(common)
            left -= 2
    return [w for w in out if w]


def test_edited_copies_of_common_words(spark):
    rng = random.Random(3)
    common = [f"w{k}" for k in range(60)]
    items = []
    for k in range(12):  # the rarest word of each item is the one that is replaced below
        words = rng.choices(common, k=28)
        words[13] = f"rare{k}"
        items.append(words)
    docs = [(k, " ".join(rng.choices(common, k=200))) for k in range(300)]
    want = {}
    for k, words in enumerate(items):
        for n, kind in enumerate(("replace", "drop", "insert")):
            copy = ["x" if w == f"rare{k}" else w for w in edited(rng, words, kind, common)] if kind != "insert" \
                else edited(rng, words, kind, common)
            doc = 1000 + 10 * k + n
            docs.append((doc, " ".join(rng.choices(common, k=40) + copy + rng.choices(common, k=40))))
    hashed = {}

    def code(text):
        return np.array([hashed.setdefault(w, len(hashed)) for w in text.split(" ")])

    for doc, text in docs:
        for k, words in enumerate(items):
            score, _ = seed_align.smith_waterman(code(" ".join(words)), code(text))
            if score >= 14:
                want[doc, k] = score
    assert len(want) >= 24
    got = seed_align.leaks(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(
        [(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")).collect()
    best = {}
    for r in got:
        best[r["doc_id"], r["item_id"]] = max(r["matched"], best.get((r["doc_id"], r["item_id"]), 0))
    assert best == want


def test_items_under_one_id_have_their_own_seeds(spark):
    rng = random.Random(4)
    items = [" ".join(f"i{k}x{rng.randint(0, 30)}" for _ in range(20)) for k in range(8)]
    docs = spark.createDataFrame([(k, "a b " + t + " c d") for k, t in enumerate(items)] + [(99, items[7])] * 50,
                                 "doc_id long, text string")
    for own in (None, 5):
        got = seed_align.leaks(docs, spark.createDataFrame([(own, t) for t in items], "item_id long, text string"))
        assert {r["doc_id"] for r in got.collect()} == {*range(8), 99}
