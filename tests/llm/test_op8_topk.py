"""Threshold algorithm against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticklake.llm import threshold_topk as T

SF = "/root/testdata/sf0.001"


def plain(rows, k=5):
    usable = [(i, np.array([math.floor(256 * x) for x in v], np.int64)) for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in usable:
        if i % 50 == 0:
            n = lambda a: min(len(a), len(q))
            best = sorted((-int(q[: n(v)] @ v[: n(v)]), j) for j, v in usable if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def test_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    assert sorted(map(tuple, T.op8_threshold_topk(spark, SF).collect())) == plain(rows)


@pytest.mark.parametrize("shard_rows", [7, 4096])
def test_edges(spark, shard_rows):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -0.5]), (50, [0.0, 0.0]), (7, [1.0, -0.5]), (8, [1.0, -0.5]), (8, [1.0, -0.5]), (9, None),
            (10, [nan, 1.0]), (11, [inf, 1.0]), (12, [None, 1.0]), (None, [1.0, 1.0]), (13, [0.25]), (100, [0.1, 0.2, 0.3]), (14, [])]
    rows += [(1000 + i, [i % 5 / 4, (i % 7 - 3) / 8]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = sorted(map(tuple, T.top_k(df, F.col("vec_id") % 50 == 0, shard_rows=shard_rows, query_rows=2).collect()))
    assert got == plain(rows)
    few = spark.createDataFrame([(0, [1.0]), (3, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in T.top_k(few, F.col("vec_id") == 0).collect()] == [(0, 1, 3, 131072)]
    assert T.top_k(few.limit(0), F.col("vec_id") == 0).count() == 0
    assert T.top_k(few, F.col("vec_id") == 77).count() == 0


def test_stops_early():
    """On one-sided data the bound ends the walk before every vector is met."""
    rng = np.random.default_rng(1)
    v = rng.integers(0, 100, (4096, 3))
    lists = T.SortedLists(np.arange(4096), v)
    met = []
    scored = lists.vectors

    class Spy:
        def __getitem__(self, at):
            met.append(len(at))
            return scored[at]

    lists.vectors = Spy()
    ids, scores = lists.top(np.array([1.0, 1.0, 1.0]), -1, 5)
    want = sorted((-int(s), i) for i, s in enumerate(v.sum(1)))[:5]
    assert [(-int(s), int(i)) for i, s in zip(ids, scores)] == want
    assert sum(met) < 2048


def test_large_components_stay_exact(spark):
    big = [(0, [1e7, 1.0, -3.0]), (1, [1e7, 1.0, 0.0]), (2, [1e7 + 1, 0.5, 0.25]), (3, [-1e7, 2.0, 1.0]), (50, [3e5, 7.0, 1 / 256]), (4, [1.0])]
    df = spark.createDataFrame(big, "vec_id long, embedding array<double>")
    exact = []
    whole = {i: [math.floor(256 * x) for x in v] for i, v in big}
    for q in (0, 50):
        found = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)
        exact += [(q, r + 1, i, min(max(-s, -(1 << 63)), (1 << 63) - 1)) for r, (s, i) in enumerate(found)]
    assert sorted(map(tuple, T.top_k(df, F.col("vec_id") % 50 == 0).collect())) == sorted(exact)
    huge = spark.createDataFrame([(0, [1e300, 1.0]), (1, [1e300, -5.0]), (2, [-1e300, 0.0])], "vec_id long, embedding array<double>")
    assert [tuple(r)[2:] for r in T.top_k(huge, F.col("vec_id") == 0).collect()] == [(1, (1 << 63) - 1), (2, -(1 << 63))]


def test_queries_are_not_broadcast(spark):
    """The queries' copies, one per band of shards, grow with the square of the table: none of them go through the driver."""
    df = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(60)], "vec_id long, embedding array<float>")
    found = T.top_k(df, F.col("vec_id") % 5 == 0, shard_rows=5, query_rows=4)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_cells_of_several_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(T, "CELLS", 4)
    monkeypatch.setattr(T, "GROUP_BLOCKS", 2)
    rows = [(i // 2 * 5 % 200, [(i * 37 % 101 - 50) / 32, (i % 7 - 3) / 8, 1e6 if i % 31 == 0 else 0.5][: 2 + i % 2]) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, T.top_k(df, F.col("vec_id") % 50 == 0, shard_rows=4, query_rows=2).collect())) == plain(rows)


def test_numbers_are_kept_in_few_bytes():
    for largest, width in ((127, 1), (-128, 1), (148, 2), (-(1 << 15), 2), (1 << 15, 4), (-(1 << 31), 4), (1 << 31, 8), ((1 << 63) - 1, 8), (-(1 << 63), 8)):
        t = T._pack(T.pa.table({"block": T.pa.array([3, 3], T.pa.int32()), "vec_id": [7, 8], "row_id": [0, 1], "q": T.pa.array([[largest, 1], [2]], T.pa.list_(T.pa.int64()))}))
        ids, row_ids, vectors = T._open(t, 0)
        assert (t["width"][0].as_py(), ids.tolist(), row_ids.tolist(), vectors.tolist()) == (width, [7, 8], [0, 1], [[largest, 1], [2, 0]])


def test_scores_below_the_least_are_not_asked_for():
    rng = np.random.default_rng(2)
    v = rng.integers(-9, 10, (300, 4))
    lists = T.SortedLists(np.arange(300), v)
    for i in range(20):
        ids, scores = lists.top(v[i].astype(float), i, 5)
        for least in (int(scores[0]) + 1, int(scores[2]), int(scores[4])):
            some, high = lists.top(v[i].astype(float), i, 5, least)
            assert some.tolist() == ids[scores >= least].tolist() and high.tolist() == scores[scores >= least].tolist()
