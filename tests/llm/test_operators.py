"""Every training-data operator against brute force on a small table with odd rows."""

import collections
import hashlib
import html
import math
import random
import re
import zlib

import numpy as np
import pytest

from meterlake.llm import (bpr_dedup, compact_windows, cost_packing, crf_html, fertility, lm_trie, odd_sketch, pii_boost,
                           rank_count, seed_align)
from meterlake.llm.elias_fano import NgramTrie

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, n_chars long, node long, band string, row int, n int, label string"


def prose(rng, n):
    out = []
    for _ in range(n):
        w = "".join(rng.choice(["tha", "er", "ing", "ou", "st", "le", "re", "an"]) for _ in range(rng.randint(1, 4)))
        out.append(w.capitalize() + "." if rng.random() < 0.1 else w)
    return " ".join(out)


def rows():
    rng = random.Random(5)
    base = prose(rng, 300)
    near = base.split(" ")
    near[150] = "changed"
    texts = [prose(rng, rng.randint(25, 120)) for _ in range(24)]
    passage = prose(rng, 70)
    texts += [base, base, " ".join(near), prose(rng, 40) + " " + passage, passage + " " + prose(rng, 60)]
    texts += [None, "", "  \n\t ", "one", "two words", "<|endoftext|> a<|startoftext|>b  \n\n x", "é́ ß Ünï 漢字 🙂 don't",
              "a" * 5000, "ha " * 300, "mail bob.x@mail.example.com or +49 (123) 555-1234, 10.1.2.3, 999.1.1.1, "
              "4111 1111 1111 1111 and 4111111111111112 token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\""]
    docs = [(i, t, "en" if i % 3 else None, len(t) if t is not None else None, 7, "x", 1, 2, "l")
            for i, t in enumerate(texts)]
    return docs + [docs[3], (None, prose(rng, 30), "en", 5, 7, "x", 1, 2, "l")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def words_of(text, lower=True):
    text = text or ""
    return WORDS.findall(text.translate(LOWER) if lower else text)


def test_language_model(docs, none):
    mu, data = 3.0, rows()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count, pair = collections.Counter(), collections.Counter()
    for i, t, *_ in data:
        if not held(i):
            seq = ["<s>", *words_of(t), "</s>"]
            count.update(seq)
            pair.update(zip(seq, seq[1:]))
    total, types = sum(count.values()) - count["<s>"], len(count) - 1

    def expected(i, t):
        seq = [*words_of(t), "</s>"]
        p1 = [(count[w] + 1) / (total + types + 1) for w in seq]
        p = [(pair[v, w] + mu * q) / (count[v] + mu) for v, w, q in zip(["<s>", *seq], seq, p1)]
        return (i, held(i), len(seq), sum(count[w] > 0 for w in seq), total, sum(map(math.log10, p1)),
                sum(map(math.log10, p)))

    want = sorted((expected(i, t) for i, t, *_ in data), key=repr)
    key = lambda r: (str(r[0]), r[2])
    for size in (400, 50):  # common words start at 25 and at 3 occurrences
        got = by_id(lm_trie.language_model_scores(docs, mu=mu, tokens_per_shard=size))
        for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
            assert g[:5] == w[:5]
            assert g[5:] == pytest.approx(w[5:], rel=1e-3)
    assert lm_trie.language_model_scores(none).collect() == []


def test_trie_finds_exactly_what_it_holds(tmp_path):
    rng = np.random.default_rng(1)
    words = np.unique(rng.integers(0, 2 ** 63, 300).astype(np.uint64))
    size = rng.integers(1, 9, len(words))
    starts = np.concatenate([[0], np.cumsum(size)])
    pool = np.unique(rng.integers(0, 2 ** 40, 500).astype(np.uint64))
    contexts = np.concatenate([np.sort(rng.choice(pool, k, replace=False)) for k in size])
    trie = NgramTrie(str(tmp_path), words, starts, contexts, np.arange(len(words), dtype=np.uint32),
                     np.arange(len(contexts), dtype=np.uint16))
    at, found = trie.find_words(np.concatenate([words, words + np.uint64(1)]))
    assert found[:len(words)].all() and (at[:len(words)] == np.arange(len(words))).all()
    assert found[len(words):].sum() == np.isin(words + np.uint64(1), words).sum()
    held = {(w, c) for w in range(len(words)) for c in contexts[starts[w]:starts[w + 1]].tolist()}
    ask_w, ask_c = rng.integers(0, len(words), 3000), rng.choice(np.append(pool, pool + np.uint64(1)), 3000)
    place, hit = trie.find_contexts(ask_w, ask_c)
    assert hit.tolist() == [(w, c) in held for w, c in zip(ask_w.tolist(), ask_c.tolist())]
    assert (contexts[place[hit]] == ask_c[hit]).all()


def test_fertility(docs, none):
    got = {}
    for r in fertility.fertility_rules(docs).collect():
        got[r["doc_id"], r["n_words"]] = r
    for i, t, *_ in rows():
        w = words_of(t, lower=False)
        r = got[i, len(w)]
        at = collections.defaultdict(list)
        for k in range(len(w) - 7):
            at[tuple(w[k:k + 8])].append(k)
        repeat = {k + j for v in at.values() if len(v) > 1 for k in v for j in range(8)}
        lines, dup = set(), 0
        for line in (t or "").split("\n"):
            if WORDS.search(line):
                dup += line in lines
                lines.add(line)
        failed = len(w) < 20 or 100 * len(repeat) > 30 * len(w)
        assert (r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == (
            sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(repeat), failed)
        assert not (failed and r["kept"])
    kept = fertility.kept_documents(docs)
    assert kept.columns == docs.columns
    assert kept.count() == fertility.fertility_rules(docs).filter("kept").count()
    assert fertility.kept_documents(none).collect() == []


@pytest.mark.parametrize("hot", [2_000, 1])
def test_repeated_strings(docs, none, hot):
    length, data = 40, rows()
    raw = [(i, (t or "").encode()) for i, t, *_ in data]
    seen = collections.Counter(b[k:k + length] for _, b in raw for k in range(len(b) - length + 1))
    want = []
    for i, b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        want.append((i, len(b), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]),
                     hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    assert by_id(bpr_dedup.without_repeated_strings(docs, length=length, hot_pieces=hot)) == sorted(want, key=repr)
    assert bpr_dedup.without_repeated_strings(none).collect() == []


def test_packing(docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = cost_packing.packed_sequences(docs).collect()
    pieces, seqs = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        pieces[r["doc_id"], r["doc_tokens"]].append(r)
        seqs[r["sequence_id"]].append(r)
    for i, t, *_ in rows():
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        own = pieces[i, len(ids)]
        times = sum(x[0] == i for x in rows())
        assert sum(r["length"] for r in own) == times * len(ids)
        for r in own:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
    for own in seqs.values():
        end = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == end
            end += r["length"]
        assert end == 4096 or end & (end - 1) == 0
    assert cost_packing.packed_sequences(none).collect() == []


def test_token_counts(docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for i, t, *_ in rows():
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 1024))
    assert by_id(rank_count.token_counts(docs)) == sorted(want, key=repr)
    assert rank_count.token_counts(none).collect() == []


def test_personal_data(docs, none):
    got = {r["doc_id"]: r for r in pii_boost.personal_data(docs).collect()}
    mixed = got[max(i for i in got if i is not None)]
    assert (mixed["n_email"], mixed["n_ip"], mixed["n_card"], mixed["n_phone"]) == (1, 1, 1, 1)
    clean = got[0]
    assert clean["spans"] == "" and clean["base_sha256"] == hashlib.sha256(b"").hexdigest()
    red = {r["doc_id"]: r for r in pii_boost.redacted(docs).collect()}
    text = red[mixed["doc_id"]]["text"]
    assert "[EMAIL]" in text and "[CARD]" in text and "999.1.1.1" in text and "bob" not in text
    assert red[mixed["doc_id"]]["n_chars"] == len(text)
    assert pii_boost.redacted(docs).columns == docs.columns
    assert pii_boost.personal_data(none).collect() == []


def test_boosted_trees_learn_and_calibrate():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0.3) & (x[:, 2] < 0.5)).astype(float)
    trees = pii_boost.BoostedTrees().fit(x[:1000], y[:1000])
    p = trees.probability(x[1000:])
    assert ((p > 0.5) == y[1000:]).mean() > 0.97
    cut = pii_boost.calibrated_threshold(p, y[1000:], 0.98)
    assert y[1000:][p >= cut].mean() >= 0.98


def test_compact_windows(docs, none):
    got = compact_windows.near_duplicate_passages(docs).collect()
    told = {(r["doc_id"], r["n_words"]): r for r in got}
    data = rows()
    seen = collections.defaultdict(set)
    for k, (i, t, *_) in enumerate(data):
        w = words_of(t)
        for a in range(len(w) - 49):
            seen[tuple(w[a:a + 50])].add(k)
    repeated = {data[k][0] for own in seen.values() if len(own) > 1 for k in own}
    near = {24, 25, 26}  # a text, its copy, and one with a word changed
    for i, t, *_ in data:
        assert (told[i, len(words_of(t))]["n_passages"] > 0) == (i in repeated | near), i
    assert len({told[i, len(words_of(data[i][1]))]["class_id"] for i in near}) == 1
    assert compact_windows.near_duplicate_passages(none).collect() == []


def test_main_text(spark):
    body = ("<p>The council met on Tuesday evening &amp; agreed to rebuild the old bridge before the winter.</p>"
            "<p>Nobody in the village\n remembers a warmer <b>spring</b> than this one.<p>Work begins in May.")
    page = ("<html><head><title>T</title><script>var a='</p>';</script></head><body><nav><ul><li><a href=x>Home</a>"
            "<li><a href=y>World</a></ul></nav><div class='cookie-notice'>We use cookies.</div><article><h1>A bridge</h1>"
            f"{body}</article><div class=comments><p>I do not believe a word.</p></div><footer>&copy; Daily</footer>")
    want = ("A bridge\nThe council met on Tuesday evening & agreed to rebuild the old bridge before the winter.\n"
            "Nobody in the village remembers a warmer spring than this one.\nWork begins in May.")
    df = spark.createDataFrame([(1, "u", page, 3), (2, None, None, 3), (3, "u", "", 3), (3, "u", "", 3),
                                (None, "u", "<p", 3)], "page_id long, url string, html string, label int")
    got = by_id(crf_html.extracted(df))
    assert got == sorted([(1, "u", want, len(want)), (2, None, "", 0), (3, "u", "", 0), (3, "u", "", 0),
                          (None, "u", "", 0)], key=repr)
    assert crf_html.extracted(df.limit(0)).collect() == []
    assert html.unescape("&amp;") == "&"


def test_near_duplicates(docs, none):
    data = rows()
    sets = []
    for _, t, *_ in data:
        w = words_of(t)
        sets.append({tuple(w[k:k + 3]) for k in range(max(1, len(w) - 2))} if w else set())
    parent = list(range(len(data)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(data)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    want = []
    for k, (i, *_) in enumerate(data):
        ids = [data[j][0] for j in range(len(data)) if root(j) == root(k) and data[j][0] is not None] if sets[k] else []
        least = min(ids) if ids else i
        want.append((i, len(sets[k]), least, i == least))
    assert by_id(odd_sketch.near_duplicates(docs, words=3, similarity=0.85)) == sorted(want, key=repr)
    assert odd_sketch.near_duplicates(none).collect() == []


def test_seed_alignment(spark, docs, none):
    rng = random.Random(9)
    item = prose(rng, 40)
    edited = item.split(" ")
    edited[5:6] = ["swapped"]
    del edited[20]
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "brief item")], "item_id long, text string")
    leaked = spark.createDataFrame(
        [(900, "before " + item + " after", "en", 1, 7, "x", 1, 2, "l"),
         (901, prose(rng, 60) + " " + " ".join(edited), "en", 1, 7, "x", 1, 2, "l")], SCHEMA)
    both = docs.union(leaked)
    got = {(r["doc_id"], r["item_id"]): r for r in seed_align.leaks(both, items).collect()}
    assert set(got) == {(900, 1), (901, 1)}
    assert got[900, 1]["score"] == 1.0 and got[900, 1]["first_word"] == 1 and got[900, 1]["last_word"] == 40
    assert seed_align.without_leaks(both, items).count() == docs.count()
    assert seed_align.leaks(none, items).collect() == []
    assert seed_align.leaks(docs, items.limit(0)).collect() == []
