"""Near-duplicate passages from compact windows of token min-hashes.

A document is its sequence of word shingles. Under one hash function, the
Cartesian tree of a sequence's hashes groups all its subsequences by their
least hash: a node with place c, spanning l to r, is a compact window, and every
subsequence of l..r that holds c has the signature of c. Windows shorter than a
passage cannot hold one and are left out, so a document yields few windows per
function; the others are the minima of a sliding stretch.

Windows of ``FUNCTIONS`` hash functions are kept where another text has their
signature. Stretches of a passage's length in which windows of enough functions
are lowest (``ENOUGH``) are spans. Two stretches of the similarity agree in fewer
than two of the eight functions with probability 0.2^8 + 8 * 0.8 * 0.2^7 =
8.4e-5; only those are never spans. Of these, candidate passages are the
stretches so many of whose shingles lie in another text's spans as the
similarity asks for; so a common line in unlike documents is no candidate.

Two near stretches share some of the rarest shingles of each: of those, by the
number of texts, a candidate has its keys (``prefix_entries``), and candidates that
share enough keys can be near. A stretch whose rarest shingles are its own
shares none, and a key of a frequent shingle tells a second one of the same
stretch; so keys few of whose candidates are near are rare. Candidates are
compared with the leader of each key first, the candidate with the most keys; so a
passage in thousands of documents costs a few comparisons for each. Then
stretches with a place in no confirmed one are compared with two leaders that have most
frequent shingles around, and the rest with all that share enough of their keys; so
are candidates of different components. No two candidates are compared twice.

Comparison is exact: shingles are matched, and a stretch of ``PASSAGE`` words
counts if it and any stretch of equal length of the partner have the
similarity. The result is a row per document with its near-duplicate
stretches and the least document id linked to it over such passages.

Defined results: a null or empty text, or one shorter than a passage, has no
passage of its own; rows of one text (repeated rows included) are linked if it
is as long as a passage; an id-less row never names a class that has an id; a
passage repeated in one document only does not count; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import SLICE_BYTES, gather_ragged, hash_words, materialise, mix, shingle_hashes, slices, split_words, two_columns
from meterlake.llm.graph import checked_broadcast, components
from meterlake.session import conf_scope
from meterlake.sources.files import remove

SHINGLE = 5
PASSAGE = 50
SIMILARITY = 0.8
FUNCTIONS = 8
ENOUGH = 2
SHARED = 2
SHIFTS = 4
BUCKET_BITS = 10
STARTS = 8192
BLOCK = 1 << 15
PAIR_BYTES = 1 << 20
LONG_WORD = 64
HOT = 16
ENTRY = "passage long, node long, rank long, key long, clean int, kind int, side boolean"
FOUND = "passage long, node long, other long, start long, end long"

RESULT = "doc_id long, n_words long, n_passages long, passage_words long, passages string, class_id long"


def cartesian_windows(values: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, start, stretches): the Cartesian-tree nodes of every sequence that span at least ``least`` places.

    A node spans that many places if and only if it is the lowest of a stretch
    of that length, so the nodes are the minima of a sliding stretch. A node is
    told with the stretches it is the lowest of: the first one's start and how
    many follow each other. Equal values: the left one is lower, and stretches
    in a row with an equal minimum are one node.
    """
    none = np.zeros(0, np.int64)
    if len(values) < least:
        return none, none, none
    place_bits = np.uint64(24)
    mask = (np.uint64(1) << place_bits) - np.uint64(1)
    low = values & ~mask | np.arange(len(values), dtype=np.uint64) & mask
    step = 1
    while 2 * step <= least:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if step < least:
        low = np.minimum(low[:step - least], low[least - step:])
    count = np.maximum(np.diff(first) - least + 1, 0)
    starts = gather_ragged(first[:-1], count)
    if not len(starts):
        return none, none, none
    low = low[starts]
    new = np.append(True, low[1:] >> place_bits != low[:-1] >> place_bits)
    new[(np.cumsum(count) - count)[count > 0]] = True
    new = np.flatnonzero(new)
    start = starts[new]
    place = start + (((low[new] & mask).astype(np.int64) - start) & int(mask))
    return place, start, np.diff(np.append(new, len(starts)))


def signature_windows(h: np.ndarray, first: np.ndarray, functions: int, least: int) -> tuple[np.ndarray, ...]:
    """(function, place, start, stretches, signature) of all compact windows of all sequences, some sequences at a time."""
    out = []
    cuts = np.unique(np.append(np.searchsorted(first, np.arange(0, int(first[-1]), BLOCK)), len(first) - 1))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        base = int(first[a])
        for f in range(functions):
            with np.errstate(over="ignore"):
                values = mix(h[base:first[b]] + np.uint64(0x632BE59BD9B4E019) * np.uint64(2 * f + 1))
            c, start, stretches = cartesian_windows(values, first[a:b + 1] - base, least)
            with np.errstate(over="ignore"):
                out.append((np.full(len(c), f), c + base, start + base, stretches, mix(values[c] + np.uint64(f))))
    if not out:
        return (*(np.zeros(0, np.int64) for _ in range(4)), np.zeros(0, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*out))


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of words by their UTF-8 bytes, eight at a time; of long ones by ``hash_words``."""
    n = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros(len(n), np.uint64)
    if not len(n):
        return out
    at = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(n)].astype(np.int64)
    text = np.frombuffer(words.buffers()[2], np.uint8)[:at[-1] + n[-1]].tobytes() + bytes(8)
    eight = np.ndarray(len(text) - 7, "<u8", text, 0, (1,))
    here = np.flatnonzero(n <= LONG_WORD)
    for k in range(0, LONG_WORD, 8):
        here = here[n[here] > k]
        if not len(here):
            break
        spare = np.maximum(k + 8 - n[here], 0).astype(np.uint64) * np.uint64(8)
        with np.errstate(over="ignore"):
            out[here] = mix(out[here] * np.uint64(0x9E3779B97F4A7C15) + (eight[at[here] + k] << spare) + np.uint64(1))
    with np.errstate(over="ignore"):
        out = mix(out + n.astype(np.uint64))
    long = np.flatnonzero(n > LONG_WORD)
    if len(long):
        out[long] = hash_words(words.take(pa.array(long)))
    return out


def shingles(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle hashes, first shingle of each text, words of each text)."""
    codes, vocabulary, first = split_words(texts, lower=True)
    h, bounds = shingle_hashes(word_hashes(vocabulary)[codes], first, words)
    return h, bounds, np.diff(first)


def word_counts(texts: pa.Array) -> np.ndarray:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text without nulls."""
    cuts = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    if data is None or not len(texts):
        return np.zeros(len(texts), np.int64)
    text = np.frombuffer(data, np.uint8)[cuts[0]:cuts[-1]]
    cuts = cuts - cuts[0]
    real = (text != 32) & ((text < 9) | (text > 13))
    new = real.copy()
    new[1:] &= ~real[:-1]
    heads = cuts[:-1][np.diff(cuts) > 0]
    new[heads] = real[heads]
    return np.diff(np.concatenate([[0], np.cumsum(new)])[cuts])


def runs_of(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))).tolist()
    return list(zip(edge[::2], edge[1::2]))


def places_before(codes: np.ndarray) -> np.ndarray:
    """The last earlier place of each place's value, -1 for none."""
    order = np.argsort(codes, kind="stable")
    out = np.full(len(codes), -1)
    same = codes[order[1:]] == codes[order[:-1]]
    out[order[1:][same]] = order[:-1][same]
    return out


def distinct_in_windows(before: np.ndarray, flags: np.ndarray, width: int) -> np.ndarray:
    """Distinct flagged values in each window of ``width`` places; a value counts at its first place in the window."""
    at, last = np.flatnonzero(flags), len(flags) - width
    lo, hi = np.maximum(np.maximum(before[at], at - width) + 1, 0), np.minimum(at, last) + 1
    real = lo < hi
    step = np.bincount(lo[real], minlength=last + 2) - np.bincount(hi[real], minlength=last + 2)
    return np.cumsum(step)[:-1]


class Side:
    """One sequence of each of many pairs, one after the other: common codes, last earlier places, distinct values of each stretch."""

    def __init__(self, codes: np.ndarray, before: np.ndarray, first: np.ndarray, width: int):
        self.codes, self.before, self.first = codes, before, first
        self.pair = np.repeat(np.arange(len(first) - 1), np.diff(first))
        self.start = np.arange(len(codes)) + width <= first[1:][self.pair]
        self.size = self.padded(distinct_in_windows(before, np.ones(len(codes), bool), width), width)
        self.size[~self.start] = width
        self.least = np.minimum.reduceat(self.size, first[:-1])
        self.starts = np.diff(first) - width + 1

    def padded(self, values: np.ndarray, fill: int) -> np.ndarray:
        return np.concatenate([values, np.full(len(self.codes) - len(values), fill)])


def sides(p: np.ndarray, first_p: np.ndarray, q: np.ndarray, first_q: np.ndarray, width: int) -> tuple[Side, Side]:
    """The two sides of pairs of sequences; a pair's values have codes of their own."""
    pair = np.concatenate([np.repeat(np.arange(len(f) - 1), np.diff(f)) for f in (first_p, first_q)])
    both = mix(np.concatenate([p, q]) ^ mix(pair.astype(np.uint64)))
    order = np.argsort(both, kind="stable")
    same = both[order[1:]] == both[order[:-1]]
    codes, before = np.zeros(len(both), np.int64), np.full(len(both), -1)
    codes[order[1:]] = np.cumsum(~same)
    a, b = order[:-1][same], order[1:][same]
    own = (a < len(p)) == (b < len(p))
    before[b[own]] = a[own]
    return (Side(codes[:len(p)], before[:len(p)], first_p, width),
            Side(codes[len(p):], np.maximum(before[len(p):] - len(p), -1), first_q, width))


def aligned(x: Side, y: Side, place: np.ndarray, width: int, similarity: float) -> np.ndarray:
    """Starts in x whose stretch is near the one of y at one of the most frequent shifts; a value counts at its first places."""
    near = np.zeros(len(x.codes), bool)
    i = np.flatnonzero((place[x.codes] >= 0) & (x.before < 0))
    of = x.pair[i]
    j = place[x.codes[i]] - y.first[of]
    i = i - x.first[of]
    shifts, count = np.unique(of << 33 | j - i + (1 << 31), return_counts=True)
    pair, shifts = shifts >> 33, (shifts & (1 << 33) - 1) - (1 << 31)
    # a near stretch shares no fewer
    few = similarity / (1 + similarity) * (x.least + y.least)
    order = np.flatnonzero(count >= few[pair] - 1e-9)
    order = order[np.lexsort((-count[order], pair[order]))]
    pair, shifts = pair[order], shifts[order]
    rank = np.arange(len(pair)) - np.searchsorted(pair, pair)
    for turn in range(SHIFTS):
        mine = rank == turn
        if not mine.any():
            break
        d, real = np.zeros(len(x.starts), np.int64), np.zeros(len(x.starts), bool)
        d[pair[mine]], real[pair[mine]] = shifts[mine], True
        a, b = np.maximum(0, -d), np.minimum(x.starts, y.starts - d)
        real &= a < b
        own = np.flatnonzero(real[of])
        k, l, m = of[own], i[own], j[own]
        m = m - d[k]
        lo, hi = np.maximum(np.maximum(l, m) - width + 1, a[k]), np.minimum(np.minimum(l, m) + 1, b[k])
        some = lo < hi
        lo, hi = (lo + x.first[k])[some], (hi + x.first[k])[some]
        both = np.cumsum(np.bincount(lo, minlength=len(near) + 1) - np.bincount(hi, minlength=len(near) + 1))[:-1]
        at = np.flatnonzero(both)
        k, both = x.pair[at], both[at]
        near[at] |= both >= similarity * (x.size[at] + y.size[at - x.first[k] + d[k] + y.first[k]] - both) - 1e-9
    return near


def near_places(x: Side, y: Side, width: int, similarity: float) -> np.ndarray:
    """Places of x inside a stretch of ``width`` places that has the similarity to any stretch of that length of its partner."""
    place = np.full(max(x.codes.max(), y.codes.max()) + 1, -1)
    place[y.codes[::-1]] = np.arange(len(y.codes))[::-1]
    known = x.padded(distinct_in_windows(x.before, place[x.codes] >= 0, width), 0)
    # no partner stretch has fewer distinct shingles than the least, nor than those shared
    least = np.maximum(similarity * x.size, similarity / (1 + similarity) * (x.size + y.least[x.pair]))
    starts = x.start & (known >= least - 1e-9)
    sure = aligned(x, y, place, width, similarity)
    at, n = np.flatnonzero(sure), len(x.codes) + 1
    flags = np.cumsum(np.bincount(at, minlength=n) - np.bincount(at + width, minlength=n))[:-1] > 0
    left = np.concatenate([[0], np.cumsum(~flags)])
    at = np.flatnonzero(starts & ~sure)
    at = at[left[at + width] > left[at]]
    pair, mark = x.pair[at], np.zeros(len(place), bool)
    for k in np.unique(pair).tolist():
        a, b = y.first[k], y.first[k + 1]
        settle(x, at[pair == k], flags, y.codes[a:b], np.maximum(y.before[a:b] - a, -1), mark, width, similarity)
    return flags


def settle(x: Side, starts: np.ndarray, flags: np.ndarray, y: np.ndarray, before: np.ndarray, mark: np.ndarray, width: int,
           similarity: float) -> None:
    """Flag the places of the stretches at ``starts`` that have the similarity to any stretch of y."""
    told: dict[int, bool] = {}

    def near(k: int) -> bool:
        if k not in told:
            a = int(starts[k])
            mark[x.codes[a:a + width]] = True
            both = distinct_in_windows(before, mark[y], width)
            mark[x.codes[a:a + width]] = False
            told[k] = bool((both >= similarity * (x.size[a] + sizes - both) - 1e-9).any())
        return told[k]

    sizes = distinct_in_windows(before, np.ones(len(y), bool), width)
    k = 0
    while k < len(starts):
        a = int(starts[k])
        if flags[a:a + width].all() or not near(k):
            k += 1
            continue
        while True:
            flags[a:a + width] = True
            # the furthest start that leaves no gap is next
            last = int(np.searchsorted(starts, a + width, side="right")) - 1
            after = next((j for j in range(last, k, -1) if near(j)), None)
            if after is None:
                k = last + 1
                break
            k, a = after, int(starts[after])


def near_stretches(p: np.ndarray, q: np.ndarray, width: int, similarity: float) -> np.ndarray:
    """Places of p inside a stretch of ``width`` shingles that has the similarity to any stretch of that length of q."""
    if len(p) < width or len(q) < width:
        return np.zeros(len(p), bool)
    return near_places(*sides(p, np.array([0, len(p)]), q, np.array([0, len(q)]), width), width, similarity)


def covered_ranges(start: np.ndarray, end: np.ndarray, enough: int) -> tuple[np.ndarray, np.ndarray]:
    """The maximal ranges whose places so many of the given ranges hold."""
    places, codes = np.unique(np.concatenate([start, end]), return_inverse=True)
    depth = np.cumsum(np.bincount(codes[:len(start)], minlength=len(places)) - np.bincount(codes[len(start):], minlength=len(places)))
    edge = np.diff(np.concatenate([[0], (depth >= enough).astype(np.int8)]))
    return places[edge > 0], places[edge < 0]


def ranges_of(row: np.ndarray, start: np.ndarray, end: np.ndarray, rows: int) -> pa.Array:
    """A list of {start, end} for each row, from ranges in the order of their rows."""
    first = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(first), pa.StructArray.from_arrays([pa.array(start), pa.array(end)], ["start", "end"]))


def flat_ranges(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the ranges in ``ranges_of`` rows."""
    n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    return np.repeat(np.arange(len(n)), n), *(flat.field(k).to_numpy() for k in ("start", "end"))


def packed(start: np.ndarray, stretches: np.ndarray, function: np.ndarray) -> np.ndarray:
    """A window's stretches and function (under 32) as one number."""
    return start << 32 | stretches << 5 | function


def unpacked(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first stretch, the last one's follower, function) of ``packed`` windows."""
    start = at >> 32
    return start, start + ((at & 0xFFFFFFFF) >> 5), at & 31


def shared(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows whose key several nodes have, those keys)."""
    if not len(keys):
        return np.zeros(0, bool), keys
    order = np.argsort(keys)
    heads = np.flatnonzero(np.append(True, np.diff(keys[order]) != 0))
    several = np.minimum.reduceat(nodes[order], heads) != np.maximum.reduceat(nodes[order], heads)
    known = np.zeros(len(keys), bool)
    known[order] = np.repeat(several, np.diff(np.append(heads, len(keys))))
    return known, keys[order][heads[several]]


def blobs_of(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """Binary values of the ranges that begin at ``first``, which ends with the length."""
    at = (first * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(values))])


def dealt(keys: np.ndarray, columns: list[np.ndarray]) -> tuple[pa.Array, list[pa.Array]]:
    """(bucket, its part of each column) by the leading bits of the keys, so that rows travel as few blobs."""
    bucket = (keys >> np.uint64(64 - BUCKET_BITS)).astype(np.uint16)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    heads = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[:len(bucket)])
    first = np.append(heads, len(bucket))
    return pa.array(bucket[heads].astype(np.int32)), [blobs_of(c[order], first) for c in columns]


def numbers(blobs: pa.Array | pa.ChunkedArray, kind: type = np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """(the numbers of all blobs, the first of each blob)."""
    n = pc.binary_length(blobs).to_numpy(zero_copy_only=False) if isinstance(blobs, pa.Array) else pc.binary_length(blobs).to_numpy()
    first = np.concatenate([[0], np.cumsum(n.astype(np.int64) // np.dtype(kind).itemsize)])
    return np.frombuffer(b"".join(blobs.to_pylist()), kind), first


def ceiling(x: np.ndarray) -> np.ndarray:
    return np.ceil(x - 1e-9).astype(np.int64)


def highest(values: np.ndarray, width: int) -> np.ndarray:
    """The highest of each place's value and the ``width`` - 1 before it."""
    step = 1
    while 2 * step <= width:
        values = np.concatenate([values[:step], np.maximum(values[step:], values[:-step])])
        step *= 2
    rest = width - step
    return np.concatenate([values[:rest], np.maximum(values[rest:], values[:-rest])]) if rest else values


def distinct(row: np.ndarray, key: np.ndarray, clean: np.ndarray, kind: int, side: bool) -> tuple[np.ndarray, ...]:
    """The different rows and keys with the highest ``clean``, and with their kind and side."""
    order = np.lexsort((-clean, key, row))
    row, key, clean = row[order], key[order], clean[order]
    new = np.append(True, (key[1:] != key[:-1]) | (row[1:] != row[:-1]))[:len(key)]
    return row[new], key[new], clean[new], np.full(new.sum(), kind), np.full(new.sum(), side)


def prefix_entries(weight: np.ndarray, first: np.ndarray, good: np.ndarray, width: int,
                   similarity: float) -> tuple[np.ndarray, ...]:
    """(sequence, key, clean, kind, side) of the rarest distinct values of the good stretches, of which near stretches share SHARED.

    ``weight``: each place's value, told by its rarity first; ``good``: the starts
    that count. Of two near stretches of s and t distinct values that share c,
    the SHARED rarest common ones are among the s - c + SHARED rarest of the
    first, and c is at least the similarity times s, or more if the partner has
    no value twice. Kind 0 is for two stretches without repeats, 2 for two with
    repeats, 1 for one of each; there, the side tells those with repeats. Stretches
    that may share fewer than SHARED values have a second key for each. Kind 3 is
    for two stretches without repeats too: two values that one stretch has among
    its rarest, if HOT texts have one of them; such a value has no key of kind 0.
    Clean: how many such values lie in the stretch and around it.
    """
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((weight, row))
    before = np.full(len(weight), -1)
    same = (weight[order[1:]] == weight[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
    before[order[1:][same]] = order[:-1][same]
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    columns = min(width, int(width - ceiling(similarity * width)) + SHARED)
    specs = [(0, False), (1, False), (1, True), (2, False)]
    least: dict[tuple[int, int], np.ndarray] = {}
    starts, twos = np.flatnonzero(good), []
    rare, hot = np.uint64(2 << 48), np.uint64(HOT << 48)
    hots = np.concatenate([[0], np.cumsum(weight >= hot)])
    for part in range(0, len(starts), STARTS):
        a = starts[part:part + STARTS]
        at = a[:, None] + np.arange(width)
        own = np.where(before[at] >= a[:, None], none, weight[at])
        size = (own != none).sum(1)
        own = np.sort(np.partition(own, columns - 1, axis=1)[:, :columns], axis=1)
        plain = size == width
        any_partner = ceiling(similarity * size)
        plain_partner = ceiling(similarity / (1 + similarity) * (size + width))
        real = plain_partner <= size
        for k, (of, c) in enumerate(((plain, plain_partner), (plain, any_partner), (~plain & real, plain_partner),
                                     (~plain, any_partner))):
            c = np.maximum(c, 1)
            n = size - c + SHARED
            last = np.where(n > columns, none, own[np.arange(len(a)), np.clip(n, 1, columns) - 1])
            for second, some in enumerate((of, of & (c < SHARED))):
                if some.any():
                    least.setdefault((k, second), np.zeros(len(weight), np.uint64))[a[some]] = last[some]
        lists = own[:, :min(columns, max(int(width - ceiling(similarity / (1 + similarity) * 2 * width)) + SHARED, 1))]
        of = plain & (own[:, 0] != none) & (lists[:, -1] >= hot)
        of &= np.append(True, (lists[1:] != lists[:-1]).any(1) | (row[a[1:]] != row[a[:-1]]) | ~of[:-1])
        lists, at = lists[of], row[a[of]]
        around = hots[np.minimum(a[of] + 2 * width - 1, first[at + 1])] - hots[np.maximum(a[of] - width + 1, first[at])]
        pairs = []
        for i in range(lists.shape[1] - 1):
            for j in range(i + 1, lists.shape[1]):
                real = np.flatnonzero((lists[:, j] >= hot) & (lists[:, i] >= rare) & (lists[:, j] != none))
                with np.errstate(over="ignore"):
                    pairs.append((at[real], mix(mix(lists[real, i]) + lists[real, j]), around[real]))
        if pairs:
            twos.append(distinct(*(np.concatenate(x) for x in zip(*pairs)), 3, False)[:3])
    out = []
    common = weight >> np.uint64(48) >= 2
    for (k, second), lowest in least.items():
        kind, side = specs[k]
        at = np.flatnonzero((weight <= highest(lowest, width)) & common & ((weight < hot) | (kind > 0) | ((0, 1) in least)))
        key = mix(weight[at]) if second else weight[at]
        out.append(distinct(row[at], key, np.zeros(len(at), np.int64), kind, side))
    if twos:
        out.append(distinct(*(np.concatenate(x) for x in zip(*twos)), 3, False))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.int64, np.int64, bool))
    return tuple(np.concatenate(x) for x in zip(*out))


def discard(written: DataFrame) -> None:
    """Delete a table of ``materialise`` that nothing reads any more."""
    for folder in {f.rpartition("/")[0] for f in written.inputFiles()}:
        remove(written.sparkSession, folder)


class NearPassages:
    """Near-duplicate passages of a document table."""

    def __init__(self, docs: DataFrame, passage: int = PASSAGE, similarity: float = SIMILARITY,
                 functions: int = FUNCTIONS, enough: int = ENOUGH, shingle: int = SHINGLE):
        self.similarity, self.functions, self.enough, self.shingle = similarity, functions, enough, shingle
        self.width = max(1, passage - shingle + 1)
        self.docs = docs.withColumn("node", F.xxhash64(F.coalesce("text", F.lit(""))))
        self.texts = self.docs.select("node", "text")

    def signatures(self) -> DataFrame:
        """(bucket, signature, node, at, known) of every compact window, as blobs; at: its stretches and function.

        known: 0, or 1 if another text of the slice has the signature; such a row
        goes to any bucket. Rows of known 2 and no node, one for each such signature and
        slice, tell the rest of the table.
        """
        functions, width, words = self.functions, self.width, self.shingle

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for nodes, texts in slices(batches):
                h, first, _ = shingles(texts, words)
                f, c, start, stretches, signature = signature_windows(h, first, functions, width)
                order = np.argsort(c)  # rows of a text lie together, so that they are written small
                f, c, start, stretches, signature = (v[order] for v in (f, c, start, stretches, signature))
                doc = np.searchsorted(first, c, side="right") - 1
                node = nodes.to_numpy()[doc]
                known, told = shared(signature, node)
                with np.errstate(over="ignore"):
                    key = np.where(known, mix(signature ^ mix(node.view(np.uint64))), signature)
                none = np.zeros(len(told), np.int64)
                bucket, blobs = dealt(np.concatenate([key, told]), [
                    np.concatenate([signature, told]), np.concatenate([node, none]),
                    np.concatenate([packed(start - first[doc], stretches, f), none]),
                    np.concatenate([known.astype(np.uint8), np.full(len(told), 2, np.uint8)])])
                yield pa.RecordBatch.from_arrays([bucket, *blobs], names=["bucket", "signature", "node", "at", "known"])

        return self.texts.mapInArrow(run, "bucket int, signature binary, node binary, at binary, known binary")

    def recurring(self, windows: DataFrame) -> DataFrame:
        """(node, signature, at) of the windows whose signature several texts have.

        One exchange: a window known to recur goes anywhere, so a bucket holds of
        a signature at most one text of each slice, and a row if it has more.
        """
        def run(table: pa.Table) -> pa.Table:
            signature, node, at, known = (numbers(table.column(c), kind)[0] for c, kind in (
                ("signature", np.uint64), ("node", np.int64), ("at", np.int64), ("known", np.uint8)))
            told = np.unique(signature[known == 2])
            keep = known == 1
            new = np.flatnonzero(known == 0)
            keep[new] = shared(signature[new], node[new])[0]
            if len(told):
                keep[new] |= told[np.minimum(np.searchsorted(told, signature[new]), len(told) - 1)] == signature[new]
            return pa.table({"node": node[keep], "signature": signature[keep].view(np.int64), "at": at[keep]})

        return windows.groupBy("bucket").applyInArrow(run, "node long, signature long, at long")

    def stretched(self, kept: DataFrame) -> DataFrame:
        """(node, spans, starts): texts with stretches in which kept windows of enough functions are lowest, and their starts."""
        width, enough = self.width, self.enough

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = batch.column("windows")
                n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
                row = np.repeat(np.arange(len(n)), n)
                at = lists.flatten().to_numpy()
                order = np.lexsort((at, row))
                at, row = at[order], row[order]
                new = np.append(True, (at[1:] != at[:-1]) | (row[1:] != row[:-1]))[:len(at)]
                # a function's windows share no stretch, so a count of windows is one of functions
                start, end, _ = unpacked(at[new])
                own = row[new] << 32
                a, b = covered_ranges(own + start, own + end, enough)
                row, a, b = a >> 32, a & 0xFFFFFFFF, b & 0xFFFFFFFF
                head = np.append(True, (row[1:] != row[:-1]) | (a[1:] > b[:-1] + width - 1))[:len(row)]
                last = np.append(head[1:], True)[:len(row)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node"), ranges_of(row[head], a[head], b[last] + width - 1, len(n)), ranges_of(row, a, b, len(n))],
                    names=["node", "spans", "starts"]).filter(pa.array(np.bincount(row, minlength=len(n)) > 0))

        lists = kept.groupBy("node").agg(F.collect_list("at").alias("windows"))
        ranges = "array<struct<start:long,end:long>>"
        return lists.mapInArrow(run, f"node long, spans {ranges}, starts {ranges}")

    def candidates(self, found: DataFrame) -> DataFrame:
        """(piece, node, spans, starts, shingles): the stretched texts with the shingles of their spans, one after the other.

        A piece is the texts of a slice, told by the first.
        """
        words = self.shingle

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for nodes, texts, spans, starts in slices(batches):
                h, first, _ = shingles(texts, words)
                row, start, end = flat_ranges(spans)
                size = np.bincount(row, end - start, minlength=len(nodes)).astype(np.int64)
                parts = blobs_of(h[gather_ragged(first[row] + start, end - start)], np.append(0, np.cumsum(size)))
                piece = pa.array(np.full(len(nodes), nodes[0].as_py()))
                yield pa.RecordBatch.from_arrays([piece, nodes, spans, starts, parts],
                                                 names=["piece", "node", "spans", "starts", "shingles"])

        texts = self.texts.join(found.select("node"), "node", "left_semi").dropDuplicates(["node"])
        return (texts.join(found, "node").select("node", "text", "spans", "starts")
                .mapInArrow(run, ", ".join(["piece long, node long", *(f"{c} {found.schema[c].dataType.simpleString()}"
                                                                       for c in ("spans", "starts")), "shingles binary"])))

    def tally(self, stretched: DataFrame) -> DataFrame:
        """(piece, bucket, count): how many texts' spans have each distinct shingle of a piece's bucket, in order, as 16-bit numbers."""
        def ask(key: tuple, table: pa.Table) -> pa.Table:
            h, first = numbers(table.column("shingles"))
            values, codes = np.unique(h, return_inverse=True)
            n = len(first) - 1
            each = np.unique(codes.reshape(-1).astype(np.int64) * n + np.repeat(np.arange(n), np.diff(first))) // n
            bucket, blobs = dealt(values, [values, np.bincount(each, minlength=len(values)).astype(np.uint32)])
            return pa.table([pa.array(np.full(len(bucket), key[0].as_py())), bucket, *blobs],
                            names=["piece", "bucket", "shingle", "texts"])

        def answer(table: pa.Table) -> pa.Table:
            h, first = numbers(table.column("shingle"))
            codes = np.unique(h, return_inverse=True)[1].reshape(-1)
            sums = np.bincount(codes, numbers(table.column("texts"), np.uint32)[0])
            return pa.table([table.column("piece").combine_chunks(), table.column("bucket").combine_chunks(),
                             blobs_of(np.minimum(sums, 65535).astype(np.uint16)[codes], first)], names=["piece", "bucket", "count"])

        asked = stretched.select("piece", "shingles").groupBy("piece").applyInArrow(
            ask, "piece long, bucket int, shingle binary, texts binary")
        return asked.groupBy("bucket").applyInArrow(answer, "piece long, bucket int, count binary")

    def passages(self, stretched: DataFrame, tally: DataFrame) -> DataFrame:
        """(passage, node, start, shingles, weights, good): stretches that have what a near duplicate has.

        Windows of enough functions are lowest there, and so many of its
        distinct shingles also lie in another text's spans as the similarity asks for; good
        tells, for each place, if such a stretch starts there. Weights: the
        shingles told by the number of texts first.
        """
        width, similarity = self.width, self.similarity

        def run(table: pa.Table, counted: pa.Table) -> pa.Table:
            h, first = numbers(table.column("shingles"))
            codes = np.unique(h, return_inverse=True)[1].reshape(-1)
            texts = numbers(counted.sort_by("bucket").column("count"), np.uint16)[0][codes]
            weight = texts.astype(np.uint64) << np.uint64(48) | mix(h) >> np.uint64(16)
            row, start, end = flat_ranges(table.column("spans").combine_chunks())
            place = np.cumsum(end - start) - (end - start)
            size = distinct_in_windows(before := places_before(codes), np.ones(len(codes), bool), width)
            known = distinct_in_windows(before, texts > 1, width)
            # spans come one after the other; starts lie in a span each
            own, a, b = flat_ranges(table.column("starts").combine_chunks())
            of = np.searchsorted(row << 32 | start, own << 32 | a, side="right") - 1
            a, b = place[of] + a - start[of], place[of] + b - start[of]
            good = np.zeros(len(codes), bool)
            at = gather_ragged(a, b - a)
            good[at[known[at] >= similarity * size[at] - 1e-9]] = True
            at = np.flatnonzero(good)
            of = np.searchsorted(place, at, side="right") - 1
            head = np.append(True, (of[1:] != of[:-1]) | (at[1:] > at[:-1] + width))[:len(at)]
            last = np.append(head[1:], True)[:len(at)]
            of, at, n = of[head], at[head], at[last] + width - at[head]
            within, first = gather_ragged(at, n), np.append(0, np.cumsum(n))
            return pa.table([table.column("node").combine_chunks().take(pa.array(row[of])), pa.array(start[of] + at - place[of]),
                             *(blobs_of(v[within], first) for v in (h, weight, good))],
                            names=["node", "start", "shingles", "weights", "good"])

        found = stretched.groupBy("piece").cogroup(tally.groupBy("piece")).applyInArrow(
            run, "node long, start long, shingles binary, weights binary, good binary")
        return found.select(F.xxhash64("node", "start").alias("passage"), "*")

    def entries(self, passages: DataFrame, found: DataFrame | None = None) -> DataFrame:
        """ENTRY: the ``prefix_entries`` of each passage; with ``found``, of its stretches with a place in no confirmed one only."""
        width, similarity, only_open = self.width, self.similarity, found is not None

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                total = np.cumsum(pc.binary_length(whole.column("weights")).to_numpy(zero_copy_only=False).astype(np.int64))
                cuts = np.unique(np.append(np.searchsorted(total, np.arange(0, int(total[-1]) if len(total) else 0, SLICE_BYTES),
                                                           side="right"), len(total)))
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    batch = whole.slice(a, b - a)
                    weight, first = numbers(batch.column("weights"))
                    good = numbers(batch.column("good"), np.uint8)[0].astype(bool)
                    if only_open:
                        done = np.zeros(len(weight), bool)
                        for base, start, spans in zip(first.tolist(), batch.column("start").to_pylist(), batch.column("spans").to_pylist()):
                            for s in spans or ():
                                done[base + s["start"] - start:base + s["end"] - start] = True
                        left = np.concatenate([[0], np.cumsum(~done)])
                        at = np.flatnonzero(good)
                        good[at[left[at + width] == left[at]]] = False
                    row, key, clean, kind, side = prefix_entries(weight, first, good, width, similarity)
                    rank, at = np.bincount(row, minlength=len(first)), pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("passage").take(at), batch.column("node").take(at), pa.array(rank[row]), pa.array(key.view(np.int64)),
                         pa.array(clean.astype(np.int32)), pa.array(kind.astype(np.int32)), pa.array(side)], names=[c.split()[0] for c in ENTRY.split(", ")])

        columns = ["passage", "node", "start", "weights", "good"]
        if found is None:
            return passages.select(*columns).mapInArrow(run, ENTRY)
        spans = found.groupBy("passage").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
        return passages.select(*columns).join(spans, "passage", "left").mapInArrow(run, ENTRY)

    def partnered(self, entries: DataFrame) -> DataFrame:
        """The entries whose key has what they can be paired with: of kind 1, both sides."""
        sided = materialise(entries.filter("kind = 1 and side").select("key").distinct(), "sided")
        lone = entries.filter("kind = 1 and not side").join(checked_broadcast(sided), "key", "left_semi")
        return entries.filter("kind != 1 or side").unionByName(lone)

    def split(self, entries: DataFrame, labels: DataFrame) -> DataFrame:
        """The entries of keys that several components have, with their label."""
        labels = labels.withColumnRenamed("node", "of_node")
        labelled = (entries.join(labels, F.col("node") == F.col("of_node"), "left")
                    .withColumn("label", F.coalesce("label", "node")).drop("of_node"))
        several = labelled.groupBy("key", "kind").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi")
        return labelled.join(several.select("key", "kind"), ["key", "kind"], "left_semi")

    def paired(self, x: DataFrame, y: DataFrame, other: str = "true") -> DataFrame:
        """(a, b): passages of different documents that share enough keys, x.* and y.* told apart by ``other`` too."""
        both = x.alias("x").join(y.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.kind") == F.col("y.kind"))
                                 & (F.col("x.node") != F.col("y.node"))
                                 & ((F.col("x.kind") != 1) | (F.col("x.side") != F.col("y.side"))) & F.expr(other))
        return (both.select(F.least("x.passage", "y.passage").alias("a"), F.greatest("x.passage", "y.passage").alias("b"), "x.key", "x.kind")
                .groupBy("a", "b").agg(F.count_distinct("key").alias("n"), F.max("kind").alias("kind"))
                .filter((F.col("n") >= SHARED) | (F.col("kind") == 3)).select("a", "b"))

    def leaders(self, entries: DataFrame, *by: Column) -> DataFrame:
        """Entries of each key, the highest by each column; of kind 1, those with repeats."""
        lead = F.array(*(F.max(F.struct("side", c.cast("double").alias("by"), "rank", "passage", "node")) for c in by))
        return (entries.groupBy("key", "kind").agg(lead.alias("lead")).select("key", "kind", F.explode("lead").alias("lead"))
                .select("key", "kind", *(F.col(f"lead.{c}").alias(c) for c in ("side", "passage", "node"))))

    def confirmed(self, passages: DataFrame, pairs: DataFrame) -> DataFrame:
        """(passage, node, other, start, end) of near-duplicate stretches, told for both sides of each pair."""
        width, similarity = self.width, self.similarity

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                total = np.cumsum(sum(pc.binary_length(whole.column(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in (6, 7)))
                first = 0
                while first < len(total):
                    end = max(int(np.searchsorted(total, (total[first - 1] if first else 0) + PAIR_BYTES, side="right")), first + 1)
                    batch = whole.slice(first, end - first)
                    first = end
                    passage, node, start = ([batch.column(c + k).to_numpy() for k in (0, 1)] for c in (0, 2, 4))
                    both = sides(*numbers(batch.column(6)), *numbers(batch.column(7)), width)
                    for s, t in ((0, 1), (1, 0)):
                        x = both[s]
                        flags = np.concatenate([near_places(x, both[t], width, similarity), [False]])
                        heads = np.zeros(len(flags), bool)
                        heads[x.first] = True
                        a = np.flatnonzero(flags & (heads | ~np.append(False, flags[:-1])))
                        b = np.flatnonzero((heads | ~flags) & np.append(False, flags[:-1]))
                        k = x.pair[a]
                        at = start[s][k] - x.first[k]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(v) for v in (passage[s][k], node[s][k], node[t][k], a + at, b + at)],
                            names=["passage", "node", "other", "start", "end"])

        x = passages.select(F.col("passage").alias("a"), F.col("node").alias("node_a"), F.col("start").alias("start_a"),
                            F.col("shingles").alias("x"))
        y = passages.select(F.col("passage").alias("b"), F.col("node").alias("node_b"), F.col("start").alias("start_b"),
                            F.col("shingles").alias("y"))
        return (pairs.join(x, "a").join(y, "b")
                .select("a", "b", "node_a", "node_b", "start_a", "start_b", "x", "y")
                .mapInArrow(run, FOUND))

    def stretches(self) -> tuple[DataFrame, DataFrame]:
        """((node, other, start, end) of all confirmed near-duplicate stretches, (a, b) links of the same components)."""
        found = materialise(self.stretched(self.recurring(self.signatures())), "spans")
        stretched = materialise(self.candidates(found), "stretched")
        passages = materialise(self.passages(stretched, self.tally(stretched)), "passages")
        discard(stretched)
        whole = materialise(self.entries(passages), "all-entries")
        entries = materialise(self.partnered(whole), "entries")
        discard(whole)
        tried = materialise(self.paired(entries, self.leaders(entries, F.col("rank"))), "pairs")
        found = materialise(self.confirmed(passages, tried), "stretches")
        # what the first leaders leave open is compared with candidates that have most frequent shingles around: the first, and any
        still = materialise(self.entries(passages, found), "open-entries").filter("kind != 0")
        spread = F.pmod(F.xxhash64("passage"), F.lit(100)) / 1000
        pairs = self.paired(still, self.leaders(self.of_keys(entries, still), F.col("clean"), F.col("clean") * (1 - spread)))
        pairs = materialise(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        found, tried = found.union(materialise(self.confirmed(passages, pairs), "stretches")), tried.union(pairs)
        still = materialise(self.entries(passages, found), "open-entries")
        labels = components(self.links(found))
        split = materialise(self.split(entries, labels), "split-entries")
        pairs = (self.paired(still, self.of_keys(entries, still)).union(self.paired(split, split, "x.label < y.label"))
                 .distinct().join(tried, ["a", "b"], "left_anti"))
        new = materialise(self.confirmed(passages, materialise(pairs, "pairs")), "stretches")
        # the last links count between components only
        apart = self.links(new)
        for c in ("a", "b"):
            apart = (apart.join(labels.select(F.col("node").alias(c), F.col("label").alias("of")), c, "left")
                     .withColumn(c, F.coalesce("of", c)).drop("of"))
        links = labels.select(F.col("label").alias("a"), F.col("node").alias("b")).union(apart.select("a", "b")).filter("a != b")
        return found.union(new), links

    def links(self, found: DataFrame) -> DataFrame:
        return found.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()

    def of_keys(self, entries: DataFrame, some: DataFrame) -> DataFrame:
        return entries.join(some.select("key", "kind").distinct(), ["key", "kind"], "left_semi")

    def classes(self) -> DataFrame:
        """One row per document: its near-duplicate passages in words, and its class."""
        tail = self.shingle - 1
        # files of an exchange go when its rows are written, or they add up over the rounds
        with conf_scope(self.docs.sparkSession, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
            found, links = self.stretches()
            found = materialise(found.select("node", "start", "end").distinct(), "found")
            labels = components(links)
        spans = found.select("node", "start", (F.col("end") + tail).alias("end"))
        lists = spans.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
        copies = (self.docs.groupBy("node").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least_id"))
                  .join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
        named = copies.groupBy("label").agg(F.min("least_id").alias("class_id"))
        of_node = copies.join(named, "label").join(lists, "node", "left").select("node", "copies", "class_id", "spans")
        passage = self.width + tail

        def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                text = pc.fill_null(batch.column("text").cast(pa.binary()), b"")
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("node"), pa.array(word_counts(text))],
                                                 names=["doc_id", "node", "n_words"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                told, counts, words, class_ids = [], [], [], []
                for doc, n, k, label, own in zip(*(c.to_pylist() for c in batch.columns)):
                    whole = (k or 0) > 1 and n >= passage
                    merged: list[list[int]] = [[0, n]] if whole else []
                    for s in () if whole else own or ():
                        if merged and s["start"] <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], s["end"])
                        else:
                            merged.append([s["start"], s["end"]])
                    told.append(",".join(f"{a}:{b}" for a, b in merged))
                    counts.append(len(merged))
                    words.append(sum(b - a for a, b in merged))
                    class_ids.append(label if merged else doc)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(words, pa.int64()),
                     pa.array(told, pa.string()), pa.array(class_ids, pa.int64())],
                    names=[c.split()[0] for c in RESULT.split(", ")])

        return (self.docs.select("doc_id", "node", "text").mapInArrow(sizes, "doc_id long, node long, n_words long")
                .join(of_node, "node", "left").select("doc_id", "n_words", "copies", "class_id", "spans").mapInArrow(run, RESULT))


def near_duplicate_passages(df: DataFrame, passage: int = PASSAGE, similarity: float = SIMILARITY, key: str = "doc_id",
                            text: str = "text") -> DataFrame:
    """Near-duplicate passages and class of every row."""
    return NearPassages(two_columns(df, key, text), passage, similarity).classes()
