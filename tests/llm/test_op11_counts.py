"""Operator 11: phrases are counted as numbers of the words of a held batch."""

from __future__ import annotations

import random
from collections import Counter

import pyarrow as pa

from ticklake.llm import prefix_free_phrases as P


def test_small_batches_are_held_together():
    batch = pa.RecordBatch.from_pydict({"x": [b"some words"] * 10})
    (held,) = P._held(iter([batch] * 50))
    assert held.num_rows == 500
    large = pa.RecordBatch.from_pydict({"x": [b"w" * 1000] * (P.HELD // 500)})
    assert 1 < len(parts := list(P._held(iter([large])))) and sum(b.num_rows for b in parts) == large.num_rows


def test_long_phrases_are_counted_exactly(spark):
    """Eight words of some hundred: too many for one number each."""
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(400)}" for _ in range(60)) for _ in range(40)] * 3
    chunks = P.dictionary(spark.createDataFrame([("de" if i % 2 else None, t) for i, t in enumerate(texts)], "lang string, text string"), 8)
    sc, every = spark.sparkContext, bytes([255]) * (1 << 13)
    got = P.gram_counts(chunks, 8, [sc.broadcast(every)] * 7).collect()
    want = Counter()
    for i, text in enumerate(texts):
        w = text.split(" ")
        want.update(("de" if i % 2 else "und", " ".join(w[k : k + 8])) for k in range(len(w) - 7))
    assert {(r.lang, r.gram): r.f for r in got} == want and len(got) == len(want)
