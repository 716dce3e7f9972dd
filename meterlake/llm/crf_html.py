"""Main-text extraction: a linear-chain conditional random field over DOM leaf blocks.

A page is read into leaf blocks, the runs of text between two block-level tag
borders, each with its open ancestors. A block's features are its ancestor
tags, the words of their class, id and role attributes, and figures of its
text (length, link share, closing punctuation, marks of legal or call-to-act
lines). The field has one weight per feature and per pair of neighbouring
labels; it is trained by gradient ascent on the likelihood of labelled pages
and decoded by Viterbi. The labelled pages are the layouts written out in
``labelled_pages`` and a bounded sample (``SAMPLE_PAGES``, at most
``SAMPLE_BLOCKS`` blocks each) of pages whose own markup names exactly one
article; a copy of each sampled page without that markup in its features is
trained on as well, so that the other features carry weight.

Blocks below a start tag with a hidden attribute, aria-hidden="true" or
``display:none`` in its style are not shown to a reader and left out, and so is what stands in a
script, style, template, textarea, svg or iframe element; other elements, math, noscript, object and canvas among
them, are read like any text. A character reference beyond Unicode is the replacement character.
Reading takes time in proportion to the page, however deep it is nested.

Defined results: a null or empty page, and one without main blocks, gives an
empty text of 0 characters; cut-off pages are read as far as they go; equal
path scores go to the boilerplate label; repeated rows are each extracted;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.labelled_pages import labelled_pages

SAMPLE_PAGES = 200
SAMPLE_BLOCKS = 40

# Elements that end a run of text; elements without content; elements whose content is no text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript "
    "ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style template textarea svg iframe".split())
# Open elements that a start tag of the same group closes, and where the search for them ends.
CLOSES = {t: frozenset(v.split()) for t, v in {
    "p": "p", "li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th",
    "option": "option", "optgroup": "option optgroup"}.items()}
P_ENDS = BLOCK_TAGS - frozenset("body button html head title option optgroup td th tr tbody thead tfoot caption".split())
SCOPES = frozenset("article aside body div footer form header main nav ol section table td th ul dl fieldset".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
ANY_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?|\"[^\"]*\"|'[^']*'")
MAY_HIDE = re.compile(r"hidden|style", re.I)
NAME_PART = re.compile(r"[a-z]+")

# Parts of class, id and role names, by what they speak of.
NAME_GROUPS = {
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs crumb crumbs tabs pagination pager toc topbar toolbar skip",
    "head": "header masthead banner branding logo hero", "foot": "footer foot copyright legal bottom colophon contentinfo",
    "side": "sidebar side aside widget widgets rail related recommended trending popular complementary teaser more",
    "ad": "ad ads advert adverts advertisement adsense sponsor sponsored promo promotion banners dfp",
    "note": "cookie cookies notice notices alert alerts consent gdpr modal popup overlay warning message toast paywall",
    "talk": "comment comments reply replies respond discussion disqus review reviews reader feedback",
    "form": "form search newsletter subscribe subscription signup login share social sharing",
    "meta": "meta byline author date tags tag category caption credit timestamp info",
    "main": "article content post entry story main body text maincontent articlebody page document prose",
}
NAME_OF = {w: g for g, words in NAME_GROUPS.items() for w in words.split()}
KEPT_TAGS = frozenset(
    "article aside blockquote button dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
    "label legend li main nav ol option p pre section select table td th title ul".split())
MANY_ZEROS = re.compile(r"&#([xX]?)0{8,}")
BEYOND = re.compile(r"&#(?:0*[1-9][0-9]{7,}|[xX]0*[1-9a-fA-F][0-9a-fA-F]{6,});?")
LEGAL = re.compile(r"©|copyright|all rights reserved|cookies?\b|privacy|terms of", re.I)
ACTION = re.compile(r"\b(?:subscribe|sign ?up|log ?in|share|click here|read more|newsletter|reply|leave a comment)\b", re.I)

RESULT = "page_id long, url string, text string, n_chars long"


@dataclass
class Block:
    """A leaf block: its text, the tags and name groups of its ancestors, and its characters inside links."""

    text: str
    tags: tuple[str, ...]
    names: frozenset[str]
    linked: int
    articles: int


def decoded(text: str) -> str:
    """Text with its character references decoded; numbers of any length are read."""
    if "&#" in text:
        text = BEYOND.sub("\ufffd", MANY_ZEROS.sub(r"&#\g<1>0", text))
    return html.unescape(text)


def hides(attributes: str) -> bool:
    """Whether a start tag has a hidden attribute, aria-hidden of true, or display none as the last one in its style."""
    if not MAY_HIDE.search(attributes):
        return False
    own: dict[str, str] = {}
    for m in ANY_ATTRIBUTE.finditer(attributes):
        if m[1]:
            own.setdefault(m[1].lower(), decoded(m[2] or m[3] or m[4] or ""))
    if "hidden" in own or own.get("aria-hidden", "").strip().lower() == "true":
        return True
    display = ""
    for rule in own.get("style", "").lower().split(";"):
        name, _, value = rule.partition(":")
        if name.strip() == "display":
            display = value.replace("!important", "").strip()
    return display == "none"


def leaf_blocks(page: str) -> list[Block]:
    """Leaf blocks of a page in order; broken or cut-off markup is read as browsers do, without an error."""
    out: list[Block] = []
    none: frozenset[str] = frozenset()
    # per open element: its tag, the different tags down to it (inner ones last), the name groups, whether hidden
    stack: list[tuple[str, tuple[str, ...], frozenset[str], bool]] = [("", (), none, False)]
    held: Counter[str] = Counter()
    words: list[tuple[str, bool]] = []
    articles = 0

    def close(depth: int) -> None:
        for tag, *_ in stack[depth:]:
            held[tag] -= 1
        del stack[depth:]

    def end_block() -> None:
        if not words:
            return
        text = " ".join(decoded("".join(w for w, _ in words)).split())
        _, tags, names, hidden = stack[-1]
        if text and not hidden:
            linked = sum(len(" ".join(w.split())) for w, inside in words if inside)
            out.append(Block(text, tags, names, linked, articles if "article" in tags else 0))
        words.clear()

    at, links = 0, 0
    while at < len(page):
        m = TOKEN.search(page, at)
        if m is None:
            words.append((page[at:], links > 0))
            break
        if m.start() > at:
            words.append((page[at:m.start()], links > 0))
        at = m.end()
        closing, tag, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if tag == "a":
                links = max(0, links - 1)
            if tag in BLOCK_TAGS:
                end_block()
                if held[tag] > 0:
                    close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag))
            continue
        if tag in RAW_TAGS:
            if not (tag == "svg" and rest.endswith("/")):  # only foreign elements can close themselves
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag == "br":
            words.append((" ", False))
        if tag == "a":
            links += 1
        if tag not in BLOCK_TAGS:
            continue
        end_block()
        if tag in VOID_TAGS:
            continue
        ends = CLOSES.get(tag, none) | (frozenset(("p",)) if tag in P_ENDS else none)
        for k in range(len(stack) - 1, 0, -1) if any(held[e] > 0 for e in ends) else ():
            if stack[k][0] in ends:
                close(k)
                break
            if stack[k][0] in SCOPES:
                break
        names = none
        if rest:
            found = ATTRIBUTE.findall(rest)
            if found:
                parts = NAME_PART.findall(" ".join("".join(x) for x in found).lower())
                names = frozenset(NAME_OF[p] for p in parts if p in NAME_OF)
        _, tags, outer, hidden = stack[-1]
        tags = tags if tags and tags[-1] == tag else (*(t for t in tags if t != tag), tag)
        stack.append((tag, tags, outer if names <= outer else outer | names, hidden or bool(rest and hides(rest))))
        held[tag] += 1
        articles += tag == "article"
        links = 0
    end_block()
    return out


@lru_cache(maxsize=100_000)
def place_features(tags: tuple[str, ...], names: frozenset[str], masked: bool) -> tuple[str, ...]:
    """Features of a block's ancestors alone; most blocks of a page share them."""
    tags = tuple(t for t in tags if t in KEPT_TAGS and not (masked and t in ("article", "main")))
    names = sorted(n for n in names if not (masked and n == "main"))
    out = [f"in:{t}" for t in dict.fromkeys(tags)] + [f"name:{x}" for x in names]
    out.append(f"own:{tags[-1] if tags else 'none'}")
    if "article" in tags or "main" in tags or "main" in names:
        odd = [x for x in ("nav", "aside", "footer", "form", "head") if x in tags] + [x for x in names if x != "main"]
        out.append("main+odd" if odd else "main")
    return tuple(out)


def block_features(b: Block, masked: bool = False) -> list[str]:
    """Names of the block's active features; ``masked`` leaves out what names an article or main element."""
    n = len(b.text)
    share = min(1.0, b.linked / max(n, 1))
    out = [*place_features(b.tags, b.names, masked), f"size:{min(8, n.bit_length())}",
           f"links:{0 if share < 0.1 else 1 if share < 0.5 else 2}"]
    if b.text[-1] in ".!?…:;\"”»":
        out.append("stop")
    if n < 300:
        if LEGAL.search(b.text):
            out.append("legal")
        if ACTION.search(b.text):
            out.append("action")
    return out


@dataclass
class ChainField:
    """Weights of the field: per feature for label 1 against label 0, and per pair of labels."""

    index: dict[str, int]
    weights: np.ndarray
    pairs: np.ndarray
    start: np.ndarray

    def decode(self, sequence: list[list[str]]) -> list[int]:
        """Most likely labels (Viterbi)."""
        if not sequence:
            return []
        get, w = self.index.get, self.weights
        emit = [sum(w[k] for f in feats if (k := get(f)) is not None) for feats in sequence]
        (t00, t01), (t10, t11) = self.pairs.tolist()
        s0, s1 = self.start[0], self.start[1] + emit[0]
        back = []
        for e in emit[1:]:
            stay0, stay1 = s0 + t00 >= s1 + t10, s0 + t01 >= s1 + t11
            back.append((0 if stay0 else 1, 0 if stay1 else 1))
            s0, s1 = (s0 + t00 if stay0 else s1 + t10), (s0 + t01 if stay1 else s1 + t11) + e
        label = 0 if s0 >= s1 else 1
        path = [label]
        for choice in reversed(back):
            label = choice[label]
            path.append(label)
        return path[::-1]


def log_add(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(sequences: list[list[tuple[list[str], int]]], rounds: int = 100, step: float = 0.25,
          decay: float = 2e-3) -> ChainField:
    """Field of highest penalised likelihood, by adaptive gradient ascent over all sequences at once."""
    sequences = [s for s in sequences if s]
    index = {f: k for k, f in enumerate(dict.fromkeys(f for s in sequences for feats, _ in s for f in feats))}
    blocks = [(p, q, feats, y) for p, s in enumerate(sequences) for q, (feats, y) in enumerate(s)]
    page, place = (np.array([b[k] for b in blocks], np.int64) for k in (0, 1))
    label = np.array([b[3] for b in blocks], np.int64)
    owner = np.repeat(np.arange(len(blocks)), [len(b[2]) for b in blocks])
    feature = np.array([index[f] for b in blocks for f in b[2]], np.int64)
    n, width = len(sequences), int(place.max()) + 1
    length = np.array([len(s) for s in sequences])
    gold = np.full((n, width), -1)
    gold[page, place] = label
    theta = np.zeros(len(index) + 6)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    true_pairs = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            true_pairs[a, b] = ((gold[:, :-1] == a) & (gold[:, 1:] == b)).sum()
    true_start = np.bincount(gold[:, 0], minlength=2).astype(float)
    true_features = np.bincount(feature, label[owner].astype(float), len(index))
    for r in range(1, rounds + 1):
        w, pairs, start = theta[:-6], theta[-6:-2].reshape(2, 2), theta[-2:]
        emit = np.zeros((n, width, 2))
        emit[page, place, 1] = np.bincount(owner, w[feature], len(blocks))
        forward = np.zeros((n, width, 2))
        backward = np.zeros((n, width, 2))
        forward[:, 0] = start + emit[:, 0]
        for k in range(1, width):
            forward[:, k] = log_add(forward[:, k - 1, :, None] + pairs, 1) + emit[:, k]
        for k in range(width - 2, -1, -1):
            step_back = log_add(pairs + (emit[:, k + 1] + backward[:, k + 1])[:, None, :], 2)
            backward[:, k] = np.where((k + 1 < length)[:, None], step_back, 0.0)
        total = log_add(forward[np.arange(n), length - 1], 1)
        node = np.exp(forward + backward - total[:, None, None])
        inside = np.arange(1, width)[None, :] < length[:, None]
        edge = np.exp(forward[:, :-1, :, None] + pairs + (emit + backward)[:, 1:, None, :] - total[:, None, None, None])
        want = np.concatenate([
            true_features - np.bincount(feature, node[page, place, 1][owner], len(index)),
            (true_pairs - (edge * inside[:, :, None, None]).sum((0, 1))).ravel(), true_start - node[:, 0].sum(0)])
        slope = want / len(blocks) - decay * theta
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope ** 2
        theta = theta + step * (first / (1 - 0.9 ** r)) / (np.sqrt(second / (1 - 0.999 ** r)) + 1e-8)
    return ChainField(index, theta[:-6], theta[-6:-2].reshape(2, 2), theta[-2:])


def layouts() -> list[list[tuple[list[str], int]]]:
    """Labelled sequences of the written-out layouts, with and without their article markup."""
    out = []
    for blocks in labelled_pages():
        for masked in (False, True):
            sequence = []
            for label, path, text, linked in blocks:
                tags, names = [], set()
                for part in path.split("/"):
                    tag, *given = part.split(".")
                    tags.append(tag)
                    names |= {NAME_OF[w] for g in given for w in NAME_PART.findall(g) if w in NAME_OF}
                block = Block(text, tuple(tags), frozenset(names), len(text) if linked else 0, 0)
                sequence.append((block_features(block, masked), label))
            out.append(sequence)
    return out


def sampled_pages(pages: DataFrame) -> list[list[tuple[list[str], int]]]:
    """Labelled sequences of at most SAMPLE_PAGES pages whose markup names exactly one article."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page in batch.column(0).to_pylist():
                blocks = leaf_blocks(page)[:SAMPLE_BLOCKS]
                if max((b.articles for b in blocks), default=0) == 1 and page.lower().count("<article") == 1:
                    out.append(json.dumps([[block_features(b), block_features(b, True), int("article" in b.tags)]
                                           for b in blocks]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["blocks"])

    some = pages.select(F.col("html").cast("string").alias("html")).filter(F.length("html") > 0)
    every = max(1, some.count() // SAMPLE_PAGES)
    rows = (some.filter(F.pmod(F.xxhash64("html"), F.lit(every)) == 0).mapInArrow(run, "blocks string")
            .distinct().orderBy(F.xxhash64("blocks"), "blocks").limit(SAMPLE_PAGES).collect())
    out = []
    for r in rows:
        blocks = json.loads(r["blocks"])
        out.append([(plain, y) for plain, _, y in blocks])
        out.append([(masked, y) for _, masked, y in blocks])
    return out


def main_text(page: str | None, field: ChainField) -> str:
    blocks = leaf_blocks(page) if page else []
    labels = field.decode([block_features(b) for b in blocks])
    return "\n".join(b.text for b, y in zip(blocks, labels) if y)


def extracted(df: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Main text of every whole page and its length in code points."""
    pages = df.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                      F.col(page).cast("string").alias("html"))
    field = train(layouts() + sampled_pages(pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(p, field) for p in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.mapInArrow(run, RESULT)
