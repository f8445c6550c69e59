"""SimHash near-duplicates against brute force."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ticklake.llm import simhash_bktree as S
from ticklake.llm.graph import components

SF = "/root/testdata/sf0.001"


def plain_fp(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def plain_components(ids, fps, radius=4):
    label = list(range(len(ids)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                label[root(i)] = root(j)
    out = {}
    for i, d in enumerate(ids):
        if d is not None:
            out[root(i)] = min(out.get(root(i), d), d)
    return [out.get(root(i)) for i in range(len(ids))]


def test_equals_brute_force(spark):
    got = {r[0]: (r[1], r[2]) for r in S.op10_simhash_neardup(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    fps = [plain_fp(t) for _, t in docs]
    want = plain_components([d for d, _ in docs], fps)
    assert got == {d: (f"{f:016x}", c) for (d, _), f, c in zip(docs, fps, want)}


@pytest.mark.parametrize("tree_rows", [4096, 16])
def test_links_of_clusters(spark, tree_rows):
    """Dense clusters, also when a key is cut into many chunks."""
    rng = np.random.default_rng(5)
    fps = set()
    for c in rng.integers(0, 1 << 63, 12):
        for _ in range(60):
            flips = {int(b) for b in rng.integers(0, 64, rng.integers(0, 5))}
            fps.add(int(c) ^ sum(1 << b for b in flips))
    fps |= {int(x) for x in rng.integers(0, 1 << 63, 300)}
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    rows = [(f, i) for i, f in enumerate(fps)]
    nodes = spark.createDataFrame(rows, "fp long, node long")
    comp = dict(components(S.links(nodes, tree_rows=tree_rows)).collect())
    want = plain_components([n for _, n in rows], [f & (2**64 - 1) for f, _ in rows])
    assert [comp.get(n, n) for _, n in rows] == want


def test_edge_cases(spark):
    rows = [(5, None, "x"), (3, "", "x"), (None, "  ", "y"), (9, "One two", "z"), (9, "one TWO", "z"),
            (None, "alone here it is", "q"), (12, "w " * 30000, "long"), (13, "w " * 30001, "long")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").withColumn("component_id", F.lit(1))
    got = S.simhash_components(docs).collect()
    by = {}
    for d, f, c in got:
        by.setdefault(d, set()).add((f, c))
    assert len(got) == 8
    assert by[5] == by[3] == {(0, 3)} and (0, 3) in by[None]
    assert len(by[9]) == 1 and next(iter(by[9]))[1] == 9
    assert next(iter(by[12]))[1] == next(iter(by[13]))[1] == 12
    assert any(c is None for _, c in by[None])
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [3, 9, 12]
    assert S.simhash_components(docs.limit(0)).count() == 0
