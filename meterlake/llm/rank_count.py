"""Token counts by rank-synchronous merging of ragged arrays.

A text is cut where a non-space character is followed by white space: no
token of the byte-level vocabulary reaches across such a place, so the pieces
can be counted one by one. The distinct pieces of a slice are split into
pre-tokens, and the distinct pre-tokens are held as one ragged symbol array.
Each round finds each sequence's lowest-rank pair and merges it in all
sequences at once. Ranks and neighbour links are kept between rounds: only the
pairs beside a merged place are looked up again, and the lowest rank of a
sequence is taken from the lowest ranks of its blocks of ``BLOCK`` places, so a
round costs what it merges and not the length of the longest pre-token. Merged
places and finished sequences leave the array once they are half of it. The
symbols that survive are the tokens.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated
rows are counted each; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from meterlake.llm.common import slices, two_columns

# The white space characters of Unicode, as the vocabulary's pattern reads \s.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECE = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
CACHE_PIECES = 600_000
BLOCK = 512

RESULT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return out


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of all stretches, one stretch after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


class Ragged:
    """Sequences of symbols end to end, with links to the neighbours and the lowest rank of each block.

    The last slot of ``symbols``, ``ranks`` and the links stands for a missing neighbour.
    """

    def __init__(self, seq: np.ndarray, symbols: np.ndarray, ranks: np.ndarray | None = None):
        n = len(seq)
        self.seq, self.symbols = seq, np.append(symbols, -1)
        self.ranks = np.zeros(n + 1, np.int64) if ranks is None else np.append(ranks, 0)
        self.gone = np.zeros(n, bool)
        first = np.flatnonzero(np.append(True, seq[1:] != seq[:-1])) if n else np.zeros(0, np.int64)
        lengths = np.diff(np.append(first, n))
        self.after, self.before = np.arange(1, n + 2), np.arange(-1, n)
        self.after[first[1:] - 1], self.after[n:] = n, n
        self.before[first], self.before[n:] = n, n
        blocks = -(-lengths // BLOCK)  # a block lies in one sequence
        self.first_block = np.cumsum(blocks) - blocks
        self.owner = np.repeat(np.arange(len(first)), blocks)
        nth = np.arange(len(self.owner)) - self.first_block[self.owner]
        self.start = first[self.owner] + nth * BLOCK
        self.size = np.minimum(lengths[self.owner] - nth * BLOCK, BLOCK)
        self.block = np.repeat(np.arange(len(self.owner)), self.size)
        self.lowest = np.zeros(len(self.owner), np.int64)
        self.alive = lengths
        self.of_place = np.repeat(np.arange(len(first)), lengths)

    def refresh(self, blocks: np.ndarray) -> None:
        """Lowest ranks of some blocks, from the ranks of their places."""
        if len(blocks):
            size = self.size[blocks]
            self.lowest[blocks] = np.minimum.reduceat(self.ranks[spread(self.start[blocks], size)],
                                                      np.cumsum(size) - size)

    def unlink_right(self, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Takes each place's right neighbour out; (places whose pair has changed, places taken out)."""
        gone = self.after[hit]
        self.after[hit] = self.after[gone]
        self.before[self.after[hit]] = hit
        self.gone[gone] = True
        np.subtract.at(self.alive, self.of_place[hit], 1)
        left = self.before[hit]
        return np.concatenate([hit, left[left < len(self.seq)]]), gone

    def alive_places(self, live: np.ndarray) -> int:
        return self.alive[live].sum()

    def compacted(self, live: np.ndarray) -> Ragged:
        """The places that are left of the sequences with a pair to merge."""
        kept = np.flatnonzero(~self.gone & live[self.of_place])
        out = Ragged(self.seq[kept], self.symbols[kept], self.ranks[kept])
        out.refresh(np.arange(len(out.start)))
        return out


class RankMerger:
    """Counts the tokens of pre-tokens under a byte-level merge table."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], np.arange(len(pairs))[order], merged[order]
        self.merged_of_rank = merged
        self.byte_ids = np.array([vocab[s] for s in byte_symbols()], np.int64)
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]
        self.special_split = re.compile("|".join(map(re.escape, self.specials))) if self.specials else None
        self.pre_tokens = regex.compile(pattern).findall
        self.counts: dict[str, int] = {}

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols; past the last rank where there is none (a missing neighbour is -1)."""
        none = len(self.keys)
        pair = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, pair), none - 1)
        return np.where(self.keys[at] == pair, self.ranks[at], none)

    def merge(self, tokens: list[bytes]) -> np.ndarray:
        """Number of symbols left of each non-empty byte string."""
        lengths = np.array([len(t) for t in tokens], np.int64)
        result = lengths.copy()
        none = len(self.keys)
        a = Ragged(np.repeat(np.arange(len(tokens)), lengths),
                   self.byte_ids[np.frombuffer(b"".join(tokens), np.uint8)])
        a.ranks[:-1] = self.pair_ranks(a.symbols[:-1], a.symbols[a.after[:-1]])
        a.refresh(np.arange(len(a.start)))
        while len(a.start):
            lowest = np.minimum.reduceat(a.lowest, a.first_block)
            live = lowest < none
            if 2 * int(a.alive_places(live)) < len(a.seq):
                a = a.compacted(live)
                continue
            if not live.any():
                break
            chosen = np.flatnonzero((a.lowest == lowest[a.owner]) & live[a.owner])
            places = spread(a.start[chosen], a.size[chosen])
            hit = places[a.ranks[places] == np.repeat(a.lowest[chosen], a.size[chosen])]
            # "aaa": of overlapping places of one pair, every second one from the left is merged
            overlap = np.append(False, a.after[hit[:-1]] == hit[1:])
            if overlap.any():
                at = np.arange(len(hit))
                hit = hit[(at - np.maximum.accumulate(np.where(overlap, 0, at))) % 2 == 0]
            np.subtract.at(result, a.seq[hit], 1)
            a.symbols[hit] = self.merged_of_rank[a.ranks[hit]]
            changed, gone = a.unlink_right(hit)
            a.ranks[gone] = none
            a.ranks[changed] = self.pair_ranks(a.symbols[changed], a.symbols[a.after[changed]])
            touched = np.zeros(len(a.start), bool)
            touched[a.block[changed]] = True
            touched[a.block[gone]] = True
            a.refresh(np.flatnonzero(touched))
        return result

    def learn(self, pieces: set[str]) -> None:
        """Adds the counts of new pieces to the cache, all pieces at once."""
        split = [self.pre_tokens(p) for p in pieces]
        distinct = {t: i for i, t in enumerate(dict.fromkeys(t for s in split for t in s))}
        if distinct:
            n = self.merge([t.encode("utf-8", "surrogatepass") for t in distinct])
            for p, s in zip(pieces, split):
                self.counts[p] = int(sum(n[distinct[t]] for t in s))

    def count(self, texts: list[str]) -> list[int]:
        if len(self.counts) > CACHE_PIECES:
            self.counts.clear()
        added, pieces = [], []
        for t in texts:
            parts = [t]
            if self.special_split and any(s in t for s in self.specials):
                parts = self.special_split.split(t)
            added.append(len(parts) - 1)
            pieces.append([p for part in parts for p in PIECE.findall(part)] if len(parts) > 1 else PIECE.findall(t))
        self.learn(set().union(*pieces) - self.counts.keys())
        get = self.counts.__getitem__
        return [a + sum(map(get, p)) for a, p in zip(added, pieces)]


@lru_cache(maxsize=2)
def merger(path: str, pattern: str) -> RankMerger:
    return RankMerger(path, pattern)


def token_counts(df: DataFrame, vocabulary: str | None = None, limit: int = 1024, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Bytes and tokens of every whole text; ``over_limit`` tells texts of more than ``limit`` tokens.

    ``vocabulary`` is the path of a byte-level tokenizer file; by default the
    installed public one, found on each executor.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers
        m = merger(vocabulary or public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
        for keys, texts in slices(batches):
            n = np.array(m.count(texts.to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays(
                [keys, pc.binary_length(texts).cast(pa.int64()), pa.array(n), pa.array(n > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return two_columns(df, key, text).mapInArrow(run, RESULT)
