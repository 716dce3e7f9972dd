"""What a task holds beside its batch while it cuts texts into pieces or shingles is bounded, and small."""

import random
import tracemalloc

import pyarrow as pa
import pytest

from meterlake.llm import bpr_dedup, odd_sketch
from meterlake.llm.common import slices


def of_pieces(texts):
    return bpr_dedup.pieces(*bpr_dedup.buffer_of(texts))


def of_shingles(texts):
    return odd_sketch.distinct_shingles(texts, 3)


@pytest.mark.parametrize("module, work, most", [(bpr_dedup, of_pieces, 64 << 20), (odd_sketch, of_shingles, 24 << 20)])
def test_a_large_batch_is_worked_on_in_small_slices(module, work, most):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(500)]
    texts = pa.array([" ".join(rng.choice(words) for _ in range(350)) for _ in range(2000)])  # about 4 MB
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000)), texts], names=["k", "t"])
    tracemalloc.start()
    done = 0
    for keys, part in slices(iter([batch]), module.SLICE):
        work(part)
        done += len(keys)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert done == 2000 and peak < most


def test_whole_slices_of_repeated_strings_meet_across_slices(spark):
    rng = random.Random(8)
    shared = "".join(rng.choice("abcdefgh ") for _ in range(300))
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(200_000)) for _ in range(6)]
    texts = [shared + t if k in (0, 5) else t for k, t in enumerate(texts)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in bpr_dedup.without_repeated_strings(df).collect()}
    assert got == {k: (300, 1) if k in (0, 5) else (0, 0) for k in range(6)}
