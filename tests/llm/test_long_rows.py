"""Rows that are very long or odd: no crash, no quadratic time, and the same spans and text as the plain rules."""

import random
import re
import time

import numpy as np
import pytest

from meterlake.llm import cost_packing, crf_html, pii_boost, rank_count, seed_align

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(t):
    digits = lambda x: re.sub(r"[^0-9]", "", x)
    luhn = lambda d: sum(x if k % 2 == 0 else 2 * x - 9 * (x > 4) for k, x in enumerate(map(int, reversed(d)))) % 10 == 0
    return {"email": [m.span() for m in EMAIL.finditer(t)],
            "ip": [m.span() for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))],
            "card": [m.span() for m in CARD.finditer(t) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))],
            "phone": [m.span() for m in PHONE.finditer(t) if 8 <= len(digits(m[0])) <= 15]}


@pytest.mark.parametrize("letters", ["ab@.", "a1@.-%", "01.9", "0.", "0123456789 -+", "+1 ().-0", "a@.1 +-0"])
def test_base_rules_equal_the_plain_patterns(letters):
    rng = random.Random(len(letters))
    for _ in range(8000):
        t = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert pii_boost.base_spans(t) == plain(t), t
    assert pii_boost.base_spans("0" * 5000 + "1.1.1.1 " + "2" * 5000 + ".1.1.1")["ip"] == [(0, 5007)]


MB = 1_000_000


@pytest.mark.parametrize("text", ["0" * MB, "0" * MB + "...", "0" * 5000 + ".1.1.1", "a" * MB + "@.", "@" * MB, "(at) " + "a" * MB,
                                  "a(at)" * (MB // 5), "+1" * (MB // 2), "1 " * (MB // 2), "=" * MB, "A1" * (MB // 2), "a.b-" * (MB // 4)])
def test_a_long_row_of_personal_data_rules(text):
    begin = time.time()
    pii_boost.base_spans(text)
    pii_boost.candidates(text)
    assert time.time() - begin < 10


def texts(page):
    return [b.text for b in crf_html.leaf_blocks(page)]


def test_odd_markup():
    assert texts("<p>a&#" + "1" * 5000 + ";b</p>") == ["a�b"]
    assert texts("<p>a&#x" + "f" * 5000 + ";b&#x110000;c&#99999999;</p>") == ["a�b�c�"]
    assert texts("<p>a&#" + "0" * 5000 + "65;&#x" + "0" * 5000 + "42;&amp;&eacute;</p>") == ["aAB&é"]
    assert texts("<script src=x.js/>var a=1;</script><p>text</p>") == ["text"]
    assert texts("<style media=a/>p {}</style>x<svg/>y<svg><text>z</text></svg>") == ["xy"]
    assert texts("<p>It holds <math>x</math> here <object>and</object> <canvas>so</canvas> on</p>") == ["It holds x here and so on"]
    assert texts("<noscript>shown</noscript>") == ["shown"]
    assert texts("</p></div>a</li><li>b<li>c") == ["a", "b", "c"]


def test_blocks_know_their_open_elements():
    blocks = crf_html.leaf_blocks("<div class=nav><ul><li>a<li>b</ul></div><article><div><p>c<p>d</div><div hidden>e</div>f</article>g")
    assert [(b.text, b.tags, sorted(b.names), b.articles) for b in blocks] == [
        ("a", ("div", "ul", "li"), ["nav"], 0), ("b", ("div", "ul", "li"), ["nav"], 0),
        ("c", ("article", "div", "p"), [], 1), ("d", ("article", "div", "p"), [], 1), ("f", ("article",), [], 1), ("g", (), [], 0)]
    # a tag that is open twice stands where it was opened last
    assert crf_html.leaf_blocks("<div><ul><li><div>x")[0].tags == ("ul", "li", "div")


@pytest.mark.parametrize("page", ["<div>" * (MB // 5), "<div>x" * (MB // 6), "<center>" * 60_000 + "</p>" * 100_000, "<p>" * (MB // 3),
                                  "<center>" * 60_000 + "<li>x" * 60_000, "x" * MB, "<" * MB, "&#" + "1" * MB, "<b>" * (MB // 3),
                                  "<td>" * (MB // 4), "<div hidden>" * (MB // 12) + "</div>" * 10])
def test_a_long_page(page):
    begin = time.time()
    crf_html.leaf_blocks(page)
    assert time.time() - begin < 10


def test_word_ids_with_a_small_cache(monkeypatch):
    """Two generations of remembered words give the library's ids, whatever is forgotten in between."""
    import public_tokenizers
    import pyarrow as pa
    monkeypatch.setattr(cost_packing, "CACHE_WORDS", 50)
    enc = cost_packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(2)
    for _ in range(40):
        batch = [" ".join(rng.choice(["the", "Über", "a1b", "don't", "x" * rng.randint(1, 30), f"w{rng.randint(0, 400)}", "end."])
                          for _ in range(60)) for _ in range(4)]
        for text, ids in zip(batch, enc.texts(pa.array(batch))):
            assert np.array_equal(ids, enc.tokenizer.encode(text, add_special_tokens=False).ids)
        assert len(enc.ids) <= 50 + 4 * 60


@pytest.fixture(scope="module")
def merger():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    return rank_count.merger(path, public_tokenizers.PATTERN), Tokenizer.from_file(path)


@pytest.mark.parametrize("letters", ["a", "ab", "abcdefghijklmnopqrstuvwxyz", "etaoin shrdlu", "é日本 aA1.", "the  an\n"])
@pytest.mark.parametrize("block", [1, 3, rank_count.BLOCK])
def test_counts_equal_the_library(merger, monkeypatch, letters, block):
    monkeypatch.setattr(rank_count, "BLOCK", block)
    counts, library = merger
    rng = random.Random(len(letters))
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 200))) for _ in range(400)]
    texts.append("".join(rng.choice(letters) for _ in range(4000)))
    counts.counts.clear()
    assert counts.count(texts) == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("letters", ["a", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJabcdefghij"])
def test_counts_of_one_long_pre_token(merger, letters):
    counts, library = merger
    text = "".join(random.Random(5).choices(letters, k=MB))
    begin = time.time()
    got = counts.count([text])
    assert time.time() - begin < 10
    assert got == [len(library.encode(text, add_special_tokens=False).ids)]


def test_bitmap_holds_every_value(spark):
    values = [0, 1, -1, 32767, 32768, 2 ** 24 - 1, 2 ** 24, 2 ** 63 - 1, -2 ** 63, *range(70_000, 70_050)]
    bits = seed_align.bitmap_of(spark.createDataFrame([(v,) for v in values * 3], "v long"), "v")
    bitmap = np.frombuffer(bits, np.uint8)
    assert len(bits) == seed_align.BITMAP_BITS >> 3
    assert seed_align.in_bitmap(bitmap, np.array(values, np.int64).view(np.uint64)).all()
    assert int(np.unpackbits(bitmap).sum()) == len({v % seed_align.BITMAP_BITS for v in values})
    empty = np.frombuffer(seed_align.bitmap_of(spark.createDataFrame([], "v long"), "v"), np.uint8)
    assert not empty.any()
