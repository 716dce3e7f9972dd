"""Elias-Fano sequences and a two-level n-gram trie made of them, with batch queries.

A monotone sequence keeps the low bits of each value packed and the high bits
as a bitmap in unary. ``select`` finds the k-th one or zero bit through a
cumulated population count; ``successor`` uses it to go straight to the few
values that share a query's high bits. All queries take arrays.
"""

from __future__ import annotations

import os

import numpy as np

CHUNK = 1 << 16
WORD = np.uint64


class Bits:
    """Bitmap with batch select of ones or zeros."""

    def __init__(self, words: np.ndarray):
        self.words = words
        ones = np.bitwise_count(words).astype(np.int64)
        self.ones = np.concatenate([[0], np.cumsum(ones)])
        self.zeros = np.arange(len(self.ones)) * 64 - self.ones

    def select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Position of the k-th (from 0) one or zero bit."""
        total = self.ones if one else self.zeros
        out = np.empty(len(k), np.int64)
        for a in range(0, len(k), CHUNK):
            part = k[a:a + CHUNK]
            at = np.searchsorted(total, part, side="right") - 1
            rank = (part - total[at]).astype(np.int64)
            word = self.words[at] if one else ~self.words[at]
            place = np.zeros(len(part), np.int64)
            for width in (32, 16, 8, 4, 2, 1):
                low = word & WORD((1 << width) - 1)
                inside = np.bitwise_count(low).astype(np.int64)
                above = rank >= inside
                rank -= np.where(above, inside, 0)
                place += np.where(above, width, 0)
                word = np.where(above, word >> WORD(width), low)
            out[a:a + CHUNK] = at * 64 + place
        return out


class EliasFano:
    """A non-decreasing sequence of 64-bit values below ``universe``."""

    def __init__(self, n: int, low_bits: int, top: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.top, self.low = n, low_bits, top, low
        self.bits = Bits(high)
        self.window = np.ndarray((max(len(low) - 7, 1),), "<u8", buffer=low, strides=(1,))
        self.mask = WORD((1 << low_bits) - 1)

    @staticmethod
    def encode(values: np.ndarray, universe: int) -> tuple[int, int, int, np.ndarray, np.ndarray]:
        """(count, low bits, largest high part, packed low parts, high bitmap) of sorted uint64 values."""
        n = len(values)
        low_bits = min(56, max(0, int(universe // max(n, 1)).bit_length() - 1))
        low = np.zeros((n * low_bits + 7) // 8 + 8, np.uint8)
        for a in range(0, n, CHUNK):  # CHUNK is a multiple of 8, so every part starts at a byte
            part = values[a:a + CHUNK]
            if low_bits:
                bits = (part[:, None] >> np.arange(low_bits, dtype=WORD)) & WORD(1)
                packed = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
                start = a * low_bits // 8
                low[start:start + len(packed)] = packed
        high_part = (values >> WORD(low_bits)).astype(np.int64)
        top = int(universe) >> low_bits
        size = n + top + 2
        flags = np.zeros((size + 63) // 64 * 64, np.uint8)
        flags[high_part + np.arange(n)] = 1
        return n, low_bits, top, low, np.packbits(flags, bitorder="little").view("<u8")

    def low_part(self, i: np.ndarray) -> np.ndarray:
        bit = i * self.low_bits
        return (self.window[bit >> 3] >> (bit & 7).astype(WORD)) & self.mask

    def access(self, i: np.ndarray) -> np.ndarray:
        """Values at positions i."""
        high = (self.bits.select(i, True) - i).astype(WORD)
        return high << WORD(self.low_bits) | self.low_part(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position of the first value >= x, whether it equals x)."""
        high = (x >> WORD(self.low_bits)).astype(np.int64)
        beyond = high > self.top
        high = np.minimum(high, self.top)
        end = self.bits.select(high, False) - high
        start = np.where(high > 0, self.bits.select(np.maximum(high - 1, 0), False) - (high - 1), 0)
        want = x & self.mask
        lo, hi = start.copy(), end.copy()
        last = max(self.n - 1, 0)
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            below = open_ & (self.low_part(np.minimum(mid, last)) < want)
            lo = np.where(below, mid + 1, lo)
            hi = np.where(open_ & ~below, mid, hi)
        equal = (lo < end) & (self.low_part(np.minimum(lo, last)) == want) if self.n else np.zeros(len(x), bool)
        return np.where(beyond, self.n, lo), equal & ~beyond


def write_sequence(folder: str, name: str, values: np.ndarray, universe: int) -> tuple[int, int, int]:
    n, low_bits, top, low, high = EliasFano.encode(values, universe)
    low.tofile(os.path.join(folder, f"{name}.low"))
    high.tofile(os.path.join(folder, f"{name}.high"))
    return n, low_bits, top


def open_sequence(folder: str, name: str, shape: tuple[int, int, int]) -> EliasFano:
    low = np.memmap(os.path.join(folder, f"{name}.low"), np.uint8, "r")
    high = np.memmap(os.path.join(folder, f"{name}.high"), "<u8", "r")
    return EliasFano(*shape, low, high)


class NgramTrie:
    """Words, each with the contexts seen before it, in memory-mapped levels.

    Level 1 is the sorted word keys; pointers into level 2 are a monotone
    sequence. Level 2 holds context numbers (ranks among all context keys),
    made monotone by adding to each the last value of the preceding word, so a
    context is searched relative to its word's start. Both levels carry a
    quantised value for each entry.
    """

    def __init__(self, folder: str, words: np.ndarray, starts: np.ndarray, contexts: np.ndarray,
                 word_codes: np.ndarray, pair_codes: np.ndarray):
        """``words`` sorted; children of word i are ``contexts[starts[i]:starts[i + 1]]``, sorted."""
        keys = np.unique(contexts)
        rank = np.searchsorted(keys, contexts).astype(np.int64)
        last = rank[starts[1:] - 1] + 1 if len(words) else np.zeros(0, np.int64)
        before = np.concatenate([[0], np.cumsum(last)])
        level = rank + np.repeat(before[:-1], np.diff(starts))
        shape = {
            "words": write_sequence(folder, "words", words, 1 << 64),
            "keys": write_sequence(folder, "keys", keys, 1 << 64),
            "starts": write_sequence(folder, "starts", starts.astype(WORD), len(contexts) + 1),
            "level": write_sequence(folder, "level", level.astype(WORD), int(before[-1]) + 1)}
        word_codes.tofile(os.path.join(folder, "words.codes"))
        pair_codes.tofile(os.path.join(folder, "level.codes"))
        self.words, self.keys, self.starts, self.level = (open_sequence(folder, k, v) for k, v in shape.items())
        self.word_codes = np.memmap(os.path.join(folder, "words.codes"), word_codes.dtype, "r") if len(words) else word_codes
        self.pair_codes = (np.memmap(os.path.join(folder, "level.codes"), pair_codes.dtype, "r") if len(contexts)
                           else pair_codes)

    def find_words(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in level 1, found) of word keys."""
        return self.words.successor(keys)

    def find_contexts(self, word: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in level 2, found) of contexts of the words at positions ``word``."""
        distinct, back = np.unique(contexts, return_inverse=True)
        rank, known = self.keys.successor(distinct)
        at, inverse = np.unique(word, return_inverse=True)
        start = self.starts.access(at).astype(np.int64)
        end = self.starts.access(at + 1).astype(np.int64)
        shift = np.where(start > 0, self.level.access(np.maximum(start - 1, 0)).astype(np.int64) + 1, 0)
        place, equal = self.level.successor((shift[inverse] + rank[back]).astype(WORD))
        return place, equal & known[back] & (place < end[inverse]) & (place >= start[inverse])
