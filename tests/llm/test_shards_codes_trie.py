"""Sharding, product codes and the prefix trie against brute force on small tables with odd rows."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from meterlake.llm import label_shards, orchard_codes, prefix_trie
from meterlake.llm.skew import spread_join


def by_repr(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- shards -----------------------------------------------------------------

DOCS = "doc_id long, text string, shard int, slot long, row string, mix int, link string"


def sharded(spark, texts, ids=None):
    ids = ids or list(range(len(texts)))
    docs = spark.createDataFrame([(i, t, 1, 2, "r", 3, "l") for i, t in zip(ids, texts)], DOCS).repartition(5)
    return [r.asDict() for r in label_shards.sharded_documents(docs).collect()]


def check_law(rows, texts):
    assert len(rows) == len(texts)
    size = lambda t: len((t or "").encode()) + 1
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == sorted(
        (size(t), zlib.crc32((t or "").encode())) for t in texts)
    loads = np.zeros(8)
    for s in range(8):
        own = [r for r in rows if r["shard"] == s]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        loads[s] = sum(r["size"] for r in own)
    assert all(r["law"] == "bytes" and r["grown_shard"] is None for r in rows)
    return loads


def shards_of_groups(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r["size"], r["text_crc32"]].append(r["shard"])
    return {k: v for k, v in groups.items() if len(v) > 1}


def test_shards_keep_groups_whole_and_bytes_even(spark):
    rng = random.Random(3)
    texts = ["x" * rng.randint(1, 4000) + str(i) for i in range(700)]
    texts += [t for t in rng.sample(texts, 60) for _ in range(rng.randint(1, 6))] + [None, "", None, "é漢🙂" * 9] * 3
    ids = [None if i % 50 == 0 else i // 2 if i % 7 == 0 else i for i in range(len(texts))]
    rows = sharded(spark, texts, ids)
    loads = check_law(rows, texts)
    assert loads.max() / loads.mean() < 1.01 and loads.min() / loads.mean() > 0.99
    groups = shards_of_groups(rows)
    assert len(groups) > 50 and all(len(set(v)) == 1 for v in groups.values())
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == sorted(i for i in ids if i is not None)


def test_a_group_of_a_third_of_all_rows_fills_few_shards(spark):
    rng = random.Random(4)
    hot = "hot " * 100
    texts = [hot] * 1000 + ["y" * rng.randint(300, 500) + str(i) for i in range(1900)]
    texts += [t for t in texts[1000:1050] for _ in range(2)]
    rows = sharded(spark, texts, [7] * 500 + [None] * 500 + list(range(len(texts) - 1000)))
    loads = check_law(rows, texts)
    assert loads.max() / loads.mean() < 1.02 and loads.min() / loads.mean() > 0.98
    groups = shards_of_groups(rows)
    # a third of eight shards is 2.7 shards; a few stragglers may stay elsewhere
    held = collections.Counter(groups.pop((len(hot) + 1, zlib.crc32(hot.encode()))))
    assert sum(n for _, n in held.most_common(4)) >= 950
    assert sum(len(set(v)) == 1 for v in groups.values()) >= 0.95 * len(groups)


def test_shards_of_linked_rows_only(spark):
    texts = [f"{i:03d}" * 50 for i in range(300) for _ in range(2)]
    rows = sharded(spark, texts)
    loads = check_law(rows, texts)
    assert loads.max() / loads.mean() < 1.05 and loads.min() / loads.mean() > 0.9
    assert sum(len(set(v)) == 1 for v in shards_of_groups(rows).values()) >= 250


def test_shards_of_little(spark):
    assert sharded(spark, []) == []
    check_law(sharded(spark, ["a"]), ["a"])
    check_law(sharded(spark, [None, "b" * 2_000_000, ""]), [None, "b" * 2_000_000, ""])


def test_nodes_with_several_links(spark):
    """Far more links stay whole than in shards by hash (a quarter of the pairs), and sizes stay even."""
    nodes = spark.createDataFrame([(i, 10, (i * 2654435761 << 20) ^ (i * 40503 << 8)) for i in range(400)],
                                  "row long, size long, mix long")
    ties = [(i, 1000 + i // 20) for i in range(400)] + [(i, 2000 + i // 40) for i in range(0, 400, 4)]
    links = spark.createDataFrame(ties, "row long, link long")
    shard = {r["row"]: r["shard"] for r in label_shards.balanced_labels(nodes, links, 4).collect()}
    counts = collections.Counter(shard.values())
    assert len(shard) == 400 and max(counts.values()) <= 120 and min(counts.values()) >= 80
    groups = [[shard[i] for i in range(k, k + 20)] for k in range(0, 400, 20)]
    assert sum(n * (n - 1) for g in groups for n in collections.Counter(g).values()) >= 0.5 * 20 * 20 * 19


def test_quota_takes_back_what_overfills():
    grant = label_shards.granted(np.array([10.0, 10.0, 0.0]), np.array([[0, 5, 0], [0, 0, 0], [0, 0, 0]]), 12)
    assert grant.sum() == 2
    full = label_shards.granted(np.array([10.0, 10.0]), np.array([[0, 5], [5, 0]]), 10)
    assert full.tolist() == [[0, 5], [5, 0]]


def test_spread_join(spark, tmpdir_path):
    data = [(1 if i % 3 == 0 else i, i) for i in range(5000)]
    spark.createDataFrame(data, "k long, v long").write.parquet(tmpdir_path + "/rows")
    rows = spark.read.parquet(tmpdir_path + "/rows")
    facts = spark.createDataFrame([(i, i * 10) for i in range(0, 5000, 2)] + [(1, 5)], "k long, f long")
    known = {i: i * 10 for i in range(0, 5000, 2)} | {1: 5}
    assert by_repr(spread_join(rows, facts, ["k"])) == sorted(((k, v, known[k]) for k, v in data if k in known), key=repr)
    assert by_repr(spread_join(rows, facts, ["k"], "left")) == sorted(((k, v, known.get(k)) for k, v in data), key=repr)


# --- product codes ----------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, code string, error long, comps int"


def brute_codes(rows):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([v for _, v, _ in kept], dtype=object).reshape(len(kept), 4, -1)
    books = x[:256].transpose(1, 0, 2).copy()

    def assign():
        gaps = np.stack([((x[:, p, None, :] - books[p][None]) ** 2).sum(axis=2).astype(object) for p in range(4)], axis=1)
        return [[min(range(len(books[0])), key=lambda e: (g[p][e], e)) for p in range(4)] for g in gaps], gaps
    for _ in range(4):
        codes, _ = assign()
        for p in range(4):
            for e in range(len(books[p])):
                own = [x[n, p] for n, c in enumerate(codes) if c[p] == e]
                if own:
                    books[p, e] = [s // len(own) for s in sum(own)]
    codes, gaps = assign()
    errors = [sum(int(g[p][c[p]]) for p in range(4)) for c, g in zip(codes, gaps)]
    by_label = collections.Counter()
    for (_, _, lab), e in zip(kept, errors):
        by_label[lab] += e
    digest = hashlib.sha256(",".join(str(int(c)) for c in books.reshape(-1)).encode()).hexdigest()
    return sorted(((i, "".join(f"{e:02x}" for e in c), err, by_label[lab], digest)
                   for (i, _, lab), c, err in zip(kept, codes, errors)), key=repr)


def codes_of(spark, rows):
    vectors = spark.createDataFrame([(i, v, lab, "c", 1, 2) for i, v, lab in rows], VECTORS).repartition(4)
    return by_repr(orchard_codes.product_codes(vectors).select("vec_id", "code", "error", "label_error", "codebooks_sha256"))


def test_product_codes(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), rng.normal(0, 0.1, 8).astype(np.float32).tolist(), None if i % 5 == 0 else int(i % 3)) for i in range(420)]
    rows += [rows[3], rows[3]] + [(1000 + i, rows[7][1], 9) for i in range(150)]  # repeated rows, one common vector
    rows += [(None, [0.5] * 8, 1), (-4, [-0.0004] * 8, 1), (2000, [300.0, -250.0] * 4, 2), (2001, [0.25] * 8, None)]
    bad = [(3000, None, 1), (3001, [None] + [0.1] * 7, 1), (3002, [float("nan")] + [0.1] * 7, 1), (3003, [float("inf")] * 8, 1)]
    assert codes_of(spark, rows + bad) == brute_codes(rows)
    # another width does not match the parts
    assert codes_of(spark, rows + [(-9, [0.1] * 4, 1), (-8, [], 2)]) == brute_codes(rows)


def test_product_codes_of_little(spark):
    assert codes_of(spark, []) == []
    assert codes_of(spark, [(1, None, 1)]) == []
    few = [(5, [0.1, 0.2, 0.3, 0.4], 1), (2, [0.1, 0.2, 0.3, -0.4], None), (2, [0.1, 0.2, 0.3, -0.4], None)]
    assert codes_of(spark, few) == brute_codes(few)
    assert len(codes_of(spark, [(1, [0.5] * 6, 1), (2, [0.25] * 6, 1)])) == 2
    assert len(codes_of(spark, [(1, [], 1), (2, [], 1)])) == 2
    huge = codes_of(spark, [(1, [3e38] * 4, 1), (2, [-3e38] * 4, 1), (3, [1e5] * 4, 1)])
    assert [r[2] for r in huge] == [0, 0, 0]


@pytest.mark.parametrize("size,width,scale", [(1, 3, 9), (2, 1, 3), (31, 4, 4), (256, 16, 500), (256, 2, 3), (200, 5, 2**26)])
def test_orchard_search_finds_the_nearest(size, width, scale):
    rng = np.random.default_rng(size + width)
    entries, points = rng.integers(-scale, scale + 1, (size, width)), rng.integers(-scale, scale + 1, (700, width))
    points[:50] = entries[rng.integers(0, size, 50)]
    gaps = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    entry, gap = orchard_codes.Orchard(entries).nearest(points)
    assert (entry == gaps.argmin(axis=1)).all() and (gap == gaps.min(axis=1)).all()


def test_orchard_search_stops_early():
    """Queries near one of many far entries leave most entries unvisited."""
    rng = np.random.default_rng(2)
    entries = rng.integers(-10**6, 10**6, (256, 8))
    points = entries[rng.integers(0, 256, 500)] + rng.integers(-5, 6, (500, 8))
    search, seen = orchard_codes.Orchard(entries), []
    whole = np.matmul
    try:
        np.matmul = lambda a, b: (seen.append(len(a)), whole(a, b))[1]
        entry, _ = search.nearest(points)
    finally:
        np.matmul = whole
    assert (entry == ((points[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert sum(seen) * orchard_codes.STEP < 0.8 * 500 * 256


# --- prefix trie ------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, depth int, h1 string, weight int"


def brute_trie(rows):
    conv = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            conv[c].append(((t is not None, t or 0), role or "", text or ""))
    own = {c: [(r, x) for _, r, x in sorted(v)] for c, v in conv.items()}
    nodes = collections.defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        whole = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:])
        for d in range(len(whole) + 1):
            nodes[whole[:d]].append((c, len(whole)))
    kids = collections.Counter(k[:-1] for k in nodes if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, members in nodes.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(members) - 1) * len(k[-1][1].encode()) if k else 0
            leaves[k[:d]] += not kids[k]
    return sorted(((m[0][0], len(k), nodes[k[:-1]][0][0] if k else None, len(m), kids[k], leaves[k], saved[k],
                    hashlib.sha256(",".join(str(c) for c, n in m if n == len(k)).encode()).hexdigest())
                   for k, m in nodes.items()), key=repr)


def trie_of(spark, rows):
    df = spark.createDataFrame([(*r, 1, "h", 2) for r in rows], TURNS).repartition(4)
    return by_repr(prefix_trie.trie_nodes(df).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                                                     "n_leaves", "saved_tokens", "ends_sha256"))


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(-7, 60), 10**12]:
        for t in range(rng.choice([1, 2, 3, 4, 8, 12])):
            rows.append((c, rng.choice([t, t, t, None, 3]), rng.choice(["user", "user", None, ""]),
                         rng.choice(["a", "b", "é", "", None, "a long text"])))
    same = [(0, "user", "hi"), (1, "assistant", "hello"), *((t, "user", "on") for t in range(2, 14))]
    rows += [(c, *turn) for c in range(100, 190, 5) for turn in same]  # identical conversations
    rows += [(c, *turn) for c in range(200, 240, 5) for turn in same[:11]]  # proper prefixes of them
    return rows + rows[:9] + [(None, 0, "user", "lost"), (None, 1, None, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_prefix_trie(spark, seed):
    rows = conversations(seed)
    assert trie_of(spark, rows) == brute_trie(rows)


def test_prefix_trie_of_one_very_long_conversation(spark):
    """A third of all turns in one conversation is spread over partitions."""
    rng = random.Random(9)
    rows = [(1000, t, "user", rng.choice("ab") * rng.randint(0, 3)) for t in range(400)]
    rows += [(c, t, "user", rng.choice("ab")) for c in range(200) for t in range(4)]
    rows += [(1005, t, r, x) for _, t, r, x in rows[:300]]
    assert trie_of(spark, rows) == brute_trie(rows)


def test_prefix_trie_of_little(spark):
    assert trie_of(spark, []) == []
    assert trie_of(spark, [(None, 1, "user", "x")]) == []
    for rows in ([(3, 0, "user", "x" * 100_000)], [(7, t, "user", "x") for t in range(3)], [(2, None, None, None)]):
        assert trie_of(spark, rows) == brute_trie(rows)


def test_end_lists_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 7)
    ends = [(2, 5, -5, i * 3) for i in range(500)] + [(2, 5, 6, 1), (0, 0, 0, 9), (0, 0, 0, -9)]
    rng = random.Random(1)
    rng.shuffle(ends)
    df = spark.createDataFrame(ends, "depth long, h1 long, h2 long, conv_id long")
    lists = collections.defaultdict(list)
    for *k, c in ends:
        lists[tuple(k)].append(c)
    want = sorted(((*k, hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest()) for k, v in lists.items()), key=repr)
    assert by_repr(prefix_trie.end_digests(df)) == want
