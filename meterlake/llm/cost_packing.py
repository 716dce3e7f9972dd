"""Cost-balanced packing of tokenised documents into sequences.

The cost of a document is estimated as linear (projections) plus quadratic
(attention) in its length. Documents are tokenised where they are read and
packed in groups of a bounded number of tokens, so neither texts nor ids are
shuffled and every task packs its own groups. In a group the number of full
sequences is fixed by its tokens; what is left over fills sequences whose
lengths are powers of two, which need no padding. Documents go in descending
order of cost to the sequence of lowest cost so far that still has room for
the whole document; a document that fits nowhere whole is cut at the largest
room there is and its rest is placed next. Rooms and tokens are equal in
number, so every id finds a place and no sequence is padded.

Defined results: a null or empty text is the closing id alone; ties of cost
go by order in the group; repeated rows are packed each; a document of any
length is cut into full sequences; an empty table gives an empty result.
Sequence ids hold the task in the upper bits, so they differ between tasks.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from meterlake.llm.common import slices, split_words, two_columns
from meterlake.llm.rank_count import byte_symbols

SEQUENCE = 4096
CLOSING_ID = 2
GROUP_TOKENS = 2 << 20
GROUP_DOCS = 20_000
CACHE_WORDS = 250_000
LINEAR, QUADRATIC = 1.0, 1.0 / SEQUENCE
SYMBOLS = byte_symbols()

RESULT = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "`offset` long")


# A word of Latin letters, then ASCII marks: two pre-tokens of the vocabulary at most, whose letters its normaliser
# only lower-cases. Digits and apostrophes start pre-tokens of their own and are left to the library.
PLAIN_WORD = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]*)").fullmatch


def packed(ids: list[int]) -> bytes:
    """Ids as 32-bit integers: a quarter of the memory of a list in the caches."""
    return array("i", ids).tobytes()


class WordEncoder:
    """Ids of whole texts through the library, which sees each distinct word part once.

    The vocabulary drops white space and never joins across it, so a text's
    ids are its words' ids in a row. Plain words go to the library's model as
    letters and marks, which their many combinations share; other words go
    through the whole library, many in one call with a special token between.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        added = self.tokenizer.get_added_tokens_decoder()
        self.separator_id = min(added)
        self.separator = added[self.separator_id].content
        self.byte_level = str.maketrans({c: "".join(SYMBOLS[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)})
        # two generations each: when the younger is full it becomes the older, and words seen again come back from it
        self.ids: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {"": b""}
        self.older_parts: dict[str, bytes] = {}

    def encode_one(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def letters(self, word: str) -> bytes:
        known = self.parts.get(word)
        if known is None and (known := self.older_parts.get(word)) is not None:
            self.parts[word] = known
        if known is None:
            known = self.parts[word] = packed([t.id for t in self.model.tokenize(
                word if word.isascii() else word.translate(self.byte_level))])
        return known

    def marks(self, tail: str) -> bytes:
        known = self.parts.get(tail)
        if known is None:
            known = self.parts[tail] = packed(self.encode_one(tail))
        return known

    def learn(self, words: list[str]) -> None:
        odd = []
        for w in words:
            plain = PLAIN_WORD(w)
            if plain:
                self.ids[w] = self.letters(plain[1].lower()) + self.marks(plain[2])
            elif self.separator in w:
                self.ids[w] = packed(self.encode_one(w))
            else:
                odd.append(w)
        for at in range(0, len(odd), 2000):
            part = odd[at:at + 2000]
            ids = self.encode_one(self.separator.join(f" {w} " for w in part))
            cuts = [k for k, x in enumerate(ids) if x == self.separator_id]
            flat = packed(ids)
            for w, a, b in zip(part, [-1, *cuts], [*cuts, len(ids)]):
                self.ids[w] = flat[4 * a + 4:4 * b]

    def texts(self, texts: pa.Array) -> list[np.ndarray]:
        codes, words, first = split_words(texts, lower=False)
        words = words.to_pylist()
        if len(self.ids) > CACHE_WORDS:
            self.older, self.ids = self.ids, {}
        if len(self.parts) > CACHE_WORDS:
            self.older_parts, self.parts = self.parts, {"": b""}
        unseen = [w for w in words if w not in self.ids]
        if self.older:
            again = [w for w in unseen if w in self.older]
            self.ids.update((w, self.older[w]) for w in again)
            unseen = [w for w in unseen if w not in self.older] if again else unseen
        self.learn(unseen)
        each = [self.ids[w] for w in words]
        length = np.array([len(x) for x in each], np.int64) // 4
        bounds = pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32())
        flat = pa.array(np.frombuffer(b"".join(each), np.int32))
        ids = pa.ListArray.from_arrays(bounds, flat).take(pa.array(codes)).flatten().to_numpy()
        ends = np.concatenate([[0], np.cumsum(length[codes])])[first]
        return [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def rooms(tokens: int, sequence: int = SEQUENCE) -> np.ndarray:
    """Lengths of a group's sequences: full ones, then the powers of two that make up the rest."""
    full, rest = divmod(tokens, sequence)
    powers = [1 << k for k in reversed(range(sequence.bit_length())) if rest >> k & 1]
    return np.array([sequence] * full + powers, np.int64)


def pack(lengths: np.ndarray, sequence: int = SEQUENCE, linear: float = LINEAR,
         quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one group of documents."""
    room = rooms(int(lengths.sum()), sequence)
    size = room.copy()
    cost = np.zeros(len(room))
    out = []

    def put(doc: int, start: int, n: int, seq: int) -> None:
        out.append((doc, start, n, seq, int(size[seq] - room[seq])))
        room[seq] -= n
        cost[seq] += linear * n + quadratic * n * n

    whole = 0  # the first sequences take the full pieces of documents longer than a sequence
    rest_start = np.zeros(len(lengths), np.int64)
    for doc in np.flatnonzero(lengths > sequence):
        for start in range(0, int(lengths[doc]) - sequence + 1, sequence):
            put(int(doc), start, sequence, whole)
            whole += 1
            rest_start[doc] = start + sequence
    rest = lengths - rest_start
    for doc in np.argsort(-(linear * rest + quadratic * rest * rest), kind="stable"):
        start, left = int(rest_start[doc]), int(rest[doc])
        while left:
            fits = room >= left
            if fits.any():
                put(int(doc), start, left, int(np.argmin(np.where(fits, cost, np.inf))))
                break
            seq = int(np.argmax(room))
            n = int(room[seq])
            put(int(doc), start, n, seq)
            start, left = start + n, left - n
    return out


def packed_sequences(df: DataFrame, vocabulary: str | None = None, sequence: int = SEQUENCE,
                     key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: its document, place in the document, checksum of ids, sequence and offset there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers
        from pyspark import TaskContext
        enc = encoder(vocabulary or public_tokenizers.path("word_bpe_49k.json"))
        next_id = TaskContext.get().partitionId() << 36
        keys: list[int | None] = []
        ids: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal next_id, held
            lengths = np.array([len(x) for x in ids], np.int64)
            rows = pack(lengths, sequence)
            batch = pa.RecordBatch.from_arrays([
                pa.array([keys[d] for d, *_ in rows], pa.int64()),
                pa.array([s for _, s, *_ in rows], pa.int64()),
                pa.array([n for _, _, n, *_ in rows], pa.int64()),
                pa.array([zlib.crc32(ids[d][s:s + n].astype("<u4").tobytes()) for d, s, n, *_ in rows], pa.int64()),
                pa.array([int(lengths[d]) for d, *_ in rows], pa.int64()),
                pa.array([next_id + q for *_, q, _ in rows], pa.int64()),
                pa.array([o for *_, o in rows], pa.int64()),
            ], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
            next_id += len(rooms(int(lengths.sum()), sequence))
            keys.clear(), ids.clear()
            held = 0
            return batch

        for k, t in slices(batches):
            for doc, x in zip(k.to_pylist(), enc.texts(t)):
                keys.append(doc)
                ids.append(np.append(x, np.int32(CLOSING_ID)))
                held += len(x) + 1
                if held >= GROUP_TOKENS or len(ids) >= GROUP_DOCS:
                    yield flush()
        if ids:
            yield flush()

    return two_columns(df, key, text).mapInArrow(run, RESULT)
