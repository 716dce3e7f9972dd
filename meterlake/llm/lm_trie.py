"""Language-model scores from a sharded Elias-Fano n-gram trie.

The model predicts a word w from the one before it, v (a start mark before the
first, an end token after the last), as

    p(w | v) = (c(v w) + MU * p1(w)) / (c(v) + MU),   p1(w) = (c(w) + 1) / (N + V + 1)

with counts c over the training part, N training tokens and V distinct ones;
it sums to one over the V tokens and one unknown.

Neither the model nor the text passes through one machine. Every slice of
documents sends its distinct (w, v) pairs, with their training counts and the
documents they occur in, to shards by w; the number of shards follows the
token count. A shard sums the counts, builds its trie (words, then contexts
before them) in memory-mapped levels with quantised log numerators, and
answers its slices' pairs by successor search. The logarithm splits into the
numerator, known in w's shard, and the denominator, known in v's, so each shard
returns sums per document. A common word would make its shard large. The
counts of words of over 1/``SPREAD`` of a shard's tokens are a table that every
task gets (at most ``COMMON`` words, as the least count is 1/COMMON of all tokens
where that is more), and pairs of such a word after another are spread over the
shards by the pair. Of at most ``HOT`` words with at least 1/HOT of all tokens
each the pairs among them are a table too, and are scored where the text is.

Defined results: a null or empty text is the end token alone; a row without an
id belongs to the training part; repeated rows are scored each; no training
rows give N = V = 0 and probability one for each token; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import gather_ragged, hash_words, materialise, mix, slices, split_words, two_columns
from meterlake.llm.elias_fano import NgramTrie

MU = 500.0
HOT = 256
SPREAD = 16
COMMON = 1 << 20
TOKENS_PER_SHARD = 1_000_000
TASKS = 20_000
SLICE = 5 << 20
LEVELS = 1 << 16
START, END = np.uint64(0), np.uint64(1)

RESULT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double")
SENT = ("shard int, slice long, words binary, children binary, contexts binary, trained binary, occurs binary, "
        "place binary, doc_id array<long>, held array<boolean>, known binary, base binary, score binary, tokens binary")
ANSWER = ("slice long, place binary, known binary, base binary, score binary, doc_id array<long>, "
          "held array<boolean>, tokens binary")


@dataclass
class Corpus:
    """Sizes of the training part and the small tables of its common and hot words."""

    tokens: int
    types: int
    docs: int
    common: np.ndarray       # sorted keys, start and end marks included
    common_counts: np.ndarray
    hot: np.ndarray          # number of each common key among the hot ones, or -1; a last -1 for other words
    pairs: np.ndarray        # counts of (v, w) among the hot keys
    mu: float

    def unigram(self, count: np.ndarray) -> np.ndarray:
        return (count + 1.0) / (self.tokens + self.types + 1.0)

    def numerator(self, pair: np.ndarray, count: np.ndarray) -> np.ndarray:
        return np.log10(pair + self.mu * self.unigram(count))

    def denominator(self, count: np.ndarray) -> np.ndarray:
        return np.log10(count + self.mu)

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10(self.unigram(count))

    def common_index(self, keys: np.ndarray) -> np.ndarray:
        """Place in the common table, or -1."""
        at = np.minimum(np.searchsorted(self.common, keys), len(self.common) - 1)
        return np.where(self.common[at] == keys, at, -1)


def word_keys(words: pa.Array) -> np.ndarray:
    """64-bit keys; 0 and 1 stand for the start and end marks."""
    return np.maximum(hash_words(words), np.uint64(2))


def chains(codes: np.ndarray, first: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Predicted code, code before it and text of every token; the end is code n_words + 1, the start n_words."""
    texts = len(first) - 1
    size = np.diff(first) + 1
    at = np.cumsum(size) - size
    doc = np.repeat(np.arange(texts), size)
    predicted = np.empty(len(codes) + texts, np.int64)
    is_end = np.zeros(len(predicted), bool)
    is_end[at + size - 1] = True
    predicted[is_end] = n_words + 1
    predicted[~is_end] = codes
    before = np.empty_like(predicted)
    before[1:] = predicted[:-1]
    before[at] = n_words
    return predicted, before, doc


def marked(docs: DataFrame) -> DataFrame:
    """doc_id, text and whether the row is held out: crc32 of the id's text leaves 2 modulo 7."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    return docs.select("doc_id", "text", held.alias("held"))


def measure(docs: DataFrame, mu: float, tokens_per_shard: int) -> Corpus:
    """Counts of the training part that every task needs."""
    train = docs.filter(~F.col("held"))

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts, _ in slices(batches, SLICE):
            codes, words, _ = split_words(texts, lower=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(word_keys(words).astype(np.int64)), pa.array(np.bincount(codes, minlength=len(words)))],
                names=["word", "n"])

    counts = materialise(train.mapInArrow(count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")),
                         "word_counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_docs = train.count()
    tokens, types = int(total["n"]) + n_docs, int(total["v"]) + (n_docs > 0)
    least = max(tokens_per_shard // SPREAD, -(-tokens // COMMON), 1)
    hot_least = max(-(-tokens // HOT), 1)
    found = counts.filter(F.col("n") >= min(least, hot_least)).toArrow()  # COMMON rows at most
    keys = np.append(found["word"].to_numpy().astype(np.uint64), [START, END])
    n = np.append(found["n"].to_numpy(), [n_docs, n_docs])
    is_hot = np.append(n[:-2] >= hot_least, [True, True])
    order = np.argsort(keys)
    keys, n, is_hot = keys[order], n[order], is_hot[order]
    hot = np.append(np.where(is_hot, np.cumsum(is_hot) - 1, -1), -1)
    n_hot = int(is_hot.sum())
    corpus = Corpus(tokens, types, n_docs, keys, n, hot, np.zeros((n_hot, n_hot), np.int64), mu)

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(corpus.pairs)
        for _, texts, _ in slices(batches, SLICE):
            codes, words, first = split_words(texts, lower=True)
            index = corpus.hot[corpus.common_index(np.append(word_keys(words), [START, END]))]
            w, v, _ = chains(codes, first, len(words))
            both = (index[w] >= 0) & (index[v] >= 0)
            found = np.bincount(index[v[both]] * n + index[w[both]], minlength=n * n)
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], names=["pair", "n"])

    for r in train.mapInArrow(count_pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        corpus.pairs.flat[r["pair"]] = r["n"]  # (HOT + 2) ** 2 rows at most
    return corpus


def packed_contexts(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def unpacked_contexts(data: bytes) -> np.ndarray:
    five = np.frombuffer(data, np.uint8).reshape(-1, 5)
    out = np.zeros((len(five), 8), np.uint8)
    out[:, :5] = five
    return out.view("<u8").ravel()


def send_slice(corpus: Corpus, n_shards: int, number: int, keys: pa.Array, texts: pa.Array, held: pa.Array) -> dict:
    """Rows of one slice: its own sums, and its pairs for each shard."""
    codes, words, first = split_words(texts, lower=True)
    w, v, doc = chains(codes, first, len(words))
    key = np.append(word_keys(words), [START, END])
    n_docs, common = len(texts), corpus.common_index(key)
    is_held = held.to_numpy(zero_copy_only=False)
    # what the small tables answer: common words' own counts, pairs of two hot words, the start mark's denominator
    cw, cv = common[w], common[v]
    own = np.where(cw >= 0, corpus.common_counts[cw], 0)
    known = np.bincount(doc, (cw >= 0) & (own > 0), n_docs)
    base = np.bincount(doc, np.where(cw >= 0, corpus.base(own), 0.0), n_docs)
    hw, hv = corpus.hot[cw], corpus.hot[cv]
    both = (hw >= 0) & (hv >= 0)
    score = np.bincount(doc[both], corpus.numerator(corpus.pairs[hv[both], hw[both]], own[both]), n_docs)
    score -= np.bincount(doc, np.where(cv >= 0, corpus.denominator(corpus.common_counts[cv]), 0.0), n_docs)
    out = {c: [] for c in ("shard", "slice", "words", "children", "contexts", "trained", "occurs", "place", "doc_id",
                           "held", "known", "base", "score", "tokens")}

    def add(**values: object) -> None:
        for c, x in out.items():
            x.append(values.get(c))

    add(shard=number % n_shards, slice=number, doc_id=keys.to_pylist(), held=held.to_pylist(),
        known=known.astype(np.int64).tobytes(), base=base.tobytes(), score=score.tobytes(),
        tokens=np.bincount(doc, minlength=n_docs).tobytes())
    # the rest as distinct pairs in order of shard, word and context
    order = np.argsort(key)
    rank = np.empty(len(key), np.int64)
    rank[order] = np.arange(len(key))
    rest = ~both
    pair = rank[w[rest]] * len(key) + rank[v[rest]]
    by_pair = np.argsort(pair, kind="stable")
    pair, place = pair[by_pair], doc[rest][by_pair]
    new = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, np.int64)
    occurs = np.diff(np.append(new, len(pair)))
    trained = np.add.reduceat((~is_held[place]).astype(np.int64), new) if len(new) else new
    word, context = key[order[pair[new] // len(key)]], key[order[pair[new] % len(key)]]
    with np.errstate(over="ignore"):
        spread = np.where(corpus.common_index(word) >= 0, mix(word + mix(context)), mix(word))
    shard = (spread % np.uint64(n_shards)).astype(np.int64)
    by_shard = np.argsort(shard, kind="stable")
    bounds = np.searchsorted(shard[by_shard], np.arange(n_shards + 1))
    for s in np.flatnonzero(np.diff(bounds)):
        at = by_shard[bounds[s]:bounds[s + 1]]
        heads = np.flatnonzero(np.append(True, word[at][1:] != word[at][:-1]))
        add(shard=int(s), slice=number, words=word[at][heads].tobytes(),
            children=np.diff(np.append(heads, len(at))).astype(np.uint32).tobytes(),
            contexts=packed_contexts(context[at]), trained=trained[at].astype(np.uint32).tobytes(),
            occurs=occurs[at].astype(np.uint32).tobytes(),
            place=place[gather_ragged(new[at], occurs[at])].astype(np.uint32).tobytes())
    return out


def quantised(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, value of each code): values rounded to at most LEVELS evenly spaced ones."""
    if not len(values):
        return np.zeros(0, np.uint16), np.zeros(1)
    book = np.linspace(values.min(), values.max(), LEVELS)
    width = book[-1] - book[0]
    codes = np.rint((values - book[0]) / width * (LEVELS - 1)) if width > 0 else np.zeros(len(values))
    return codes.astype(np.uint16), book


def answer_shard(corpus: Corpus, sent: pa.Table) -> dict:
    """Sums per slice and document from one shard's pairs: counts, trie, look-up."""
    rows = sent.to_pylist()
    out = {c: [] for c in ("slice", "place", "known", "base", "score", "doc_id", "held", "tokens")}
    texts = [r for r in rows if r["words"] is None]
    for r in texts:
        for c, x in out.items():
            x.append(r[c])
    rows = [r for r in rows if r["words"] is not None]
    if not rows:
        return out
    children = [np.frombuffer(r["children"], np.uint32) for r in rows]
    word = np.concatenate([np.repeat(np.frombuffer(r["words"], np.uint64), c) for r, c in zip(rows, children)])
    context = np.concatenate([unpacked_contexts(r["contexts"]) for r in rows])
    trained = np.concatenate([np.frombuffer(r["trained"], np.uint32) for r in rows]).astype(np.int64)
    order = np.lexsort((context, word))
    sw, sc = word[order], context[order]
    new = np.flatnonzero(np.append(True, (sw[1:] != sw[:-1]) | (sc[1:] != sc[:-1])))
    count = np.add.reduceat(trained[order], new)
    seen = count > 0
    pair_word, pair_context, pair_count = sw[new][seen], sc[new][seen], count[seen]
    heads = np.flatnonzero(np.append(True, pair_word[1:] != pair_word[:-1])) if len(pair_word) else np.zeros(0, np.int64)
    words = pair_word[heads]
    starts = np.append(heads, len(pair_word))
    common = corpus.common_index(words)
    word_count = np.add.reduceat(pair_count, heads) if len(heads) else np.zeros(0, np.int64)
    word_count = np.where(common >= 0, corpus.common_counts[common], word_count)
    counts_book, word_codes = np.unique(word_count, return_inverse=True)
    pair_codes, book = quantised(corpus.numerator(pair_count, np.repeat(word_count, np.diff(starts))))
    with tempfile.TemporaryDirectory(prefix="trie-") as folder:
        trie = NgramTrie(folder, words, starts, pair_context, word_codes.astype(np.uint32), pair_codes)
        asked_word, asked_context = sw[new], sc[new]
        distinct, back = np.unique(asked_word, return_inverse=True)
        at, known = trie.find_words(distinct)
        own = np.zeros(len(distinct), np.int64)
        own[known] = counts_book[trie.word_codes[at[known]]]
        is_common = corpus.common_index(distinct)
        own = np.where(is_common >= 0, corpus.common_counts[is_common], own)
        value = corpus.numerator(np.zeros(len(back)), own[back])
        there = np.flatnonzero(known[back])
        place, found = trie.find_contexts(at[back[there]], asked_context[there])
        value[there[found]] = book[trie.pair_codes[place[found]]]
    # a word that is not common answers for its own count too: base score and its denominator as the next word's context
    cold = is_common[back] < 0
    value -= np.where(cold, corpus.denominator(own[back]), 0.0)
    base = np.where(cold, corpus.base(own[back]), 0.0)
    known_token = cold & (own[back] > 0)
    group = np.empty(len(word), np.int64)
    group[order] = np.cumsum(np.bincount(new, minlength=len(word))) - 1
    start = 0
    for r, c in zip(rows, children):
        n = int(c.sum())
        mine = np.repeat(group[start:start + n], np.frombuffer(r["occurs"], np.uint32))
        start += n
        docs, at = np.unique(np.frombuffer(r["place"], np.uint32), return_inverse=True)
        out["slice"].append(r["slice"])
        out["place"].append(docs.tobytes())
        out["known"].append(np.bincount(at, known_token[mine], len(docs)).astype(np.uint32).tobytes())
        out["base"].append(np.bincount(at, base[mine], len(docs)).tobytes())
        out["score"].append(np.bincount(at, value[mine], len(docs)).astype(np.float32).tobytes())
        for k in ("doc_id", "held", "tokens"):
            out[k].append(None)
    return out


def sum_slice(train_tokens: int, answers: pa.Table) -> pa.Table:
    """Final rows of one slice from its own sums and the shards' answers."""
    rows = answers.to_pylist()
    own = next(r for r in rows if r["tokens"] is not None)
    known, base, score = (np.frombuffer(own[c], t).copy() for c, t in
                          (("known", np.int64), ("base", np.float64), ("score", np.float64)))
    for r in rows:
        if r["tokens"] is None:
            at = np.frombuffer(r["place"], np.uint32)
            known[at] += np.frombuffer(r["known"], np.uint32)
            base[at] += np.frombuffer(r["base"], np.float64)
            score[at] += np.frombuffer(r["score"], np.float32)
    n = len(known)
    return pa.table({"doc_id": pa.array(own["doc_id"], pa.int64()), "held_out": pa.array(own["held"], pa.bool_()),
                     "n_tokens": np.frombuffer(own["tokens"], np.int64), "n_known": known,
                     "train_tokens": np.full(n, train_tokens, np.int64), "base_score": base, "score": score})


def language_model_scores(df: DataFrame, mu: float = MU, tokens_per_shard: int = TOKENS_PER_SHARD,
                          key: str = "doc_id", text: str = "text") -> DataFrame:
    """Log10 probability of every whole text under the model of the training part, and under its unigrams."""
    docs = marked(two_columns(df, key, text))
    corpus = measure(docs, mu, tokens_per_shard)
    n_shards = max(1, -(-corpus.tokens // tokens_per_shard))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        for keys, texts, held in slices(batches, SLICE):
            rows = send_slice(corpus, n_shards, number, keys, texts, held)
            number += 1
            yield pa.RecordBatch.from_pydict(rows, schema=sent_schema)

    def answer(sent: pa.Table) -> pa.Table:
        return pa.Table.from_pydict(answer_shard(corpus, sent), schema=answer_schema)

    train_tokens = corpus.tokens
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
             "array<boolean>": pa.list_(pa.bool_())}
    sent_schema, answer_schema = (pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in s.split(", ")])
                                  for s in (SENT, ANSWER))
    # one shard a task up to TASKS; beyond, a task takes its shards one after another
    tasks = min(n_shards, TASKS)
    sent = docs.mapInArrow(send, SENT).withColumn("task", F.col("shard") % tasks).repartitionById(tasks, F.col("task"))
    answers = sent.groupBy("task", "shard").applyInArrow(answer, ANSWER).repartition(tasks, "slice")
    return answers.groupBy("slice").applyInArrow(lambda t: sum_slice(train_tokens, t), RESULT)
