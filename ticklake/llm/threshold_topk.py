"""Exact top-k inner product search by Fagin's threshold algorithm (operator 8).

Vectors are dealt into shards. A shard holds, per dimension, its vectors sorted
by that component. For a query the lists are read from the favourable end
(largest components where the query's is positive, smallest where negative),
all to the same depth; each vector met is scored in full. After each round the
bound, the inner product of the query with the components at the current
depth, is the best score an unseen vector can have: once it is below the kth
score (strictly, as ties go to smaller ids), the shard is done.

The stated queries meet the shards in cells: a band of shards and a group of
blocks of queries, brought together by a shuffle on the cell's number. A cell
has a bounded number of shards and blocks, whatever the table's size; nothing
is broadcast, as the queries' copies grow with the square of the table. The
kth score a query has from the shards before ends the later walks of a cell
sooner. Only k rows per query and band are shuffled on to the final ranking.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import partitions_for, stored

K = 5
SHARD_ROWS = 4096
QUERY_ROWS = 1024
QUERY_EVERY = 50
CELLS = 64  # a band is one shard up to this number of shards
BAND_SHARDS = 16  # the most shards of a band
GROUP_BLOCKS = 64  # the most blocks of queries of a group
MOST_TASKS = 4096  # cells are dealt to twice their number of tasks, or to this number


class SortedLists:
    """One shard: vectors (rows x dims, whole numbers) and their sorted lists.

    ``kind``: the numbers that hold every sum of ``top`` exactly (``exact_kind``).
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, kind=np.float64):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        self.ids, self.vectors, self.kind = ids, vectors.astype(kind), kind
        # one falling list per dimension
        self.order = np.ascontiguousarray(np.argsort(vectors.T, axis=1, kind="stable")[:, ::-1])
        self.sorted = np.take_along_axis(self.vectors, self.order.T, 0)

    def top(self, query: np.ndarray, query_id: int, k: int, least: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best other vectors, best first, ties to smaller ids.

        ``least``: scores below it aren't asked for."""
        n = len(self.ids)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        seen = np.zeros(n, bool)
        seen[np.searchsorted(self.ids, query_id) : np.searchsorted(self.ids, query_id, "right")] = True  # its own
        best_at, best, scores = np.zeros(0, np.int64), np.zeros(0, self.kind), None
        depth, step = 0, max(1, n // 64)
        while not seen.all():
            end = min(n, depth + step)
            before = seen.copy()
            seen[self.order[up, depth:end]] = True
            seen[self.order[down, n - end : n - depth]] = True
            if not len(up) and not len(down):
                seen[depth:end] = True  # a zero query: every score is 0
            new = np.flatnonzero(seen != before)
            if scores is None and len(new) * 4 > n and self.kind is not object:
                scores = self.vectors @ query  # sooner done than copies of so many rows
            score = np.concatenate([best, self.vectors[new] @ query if scores is None else scores[new]])
            at = np.concatenate([best_at, new])
            if least is not None:
                enough = score >= least
                at, score = at[enough], score[enough]
            if len(score) > 4 * k:
                enough = score >= np.partition(score, -k)[-k]
                at, score = at[enough], score[enough]
            keep = np.lexsort((at, -score))[:k]
            best_at, best = at[keep], score[keep]
            bound = query[up] @ self.sorted[end - 1, up] + query[down] @ self.sorted[n - end, down]
            if (len(best) == k and best[-1] > bound) or (least is not None and bound < least):
                break
            depth, step = end, step * 2
        return self.ids[best_at], best


def exact_kind(a: np.ndarray, b: np.ndarray):
    """Floats while inner products of rows of ``a`` and ``b`` stay below 2^24 (32 bits)
    or 2^53, 64-bit integers below 2^63, else Python's integers."""
    largest = lambda m: max(int(m.max(initial=0)), -int(m.min(initial=0)))
    most = max(a.shape[1], b.shape[1]) * max(largest(a), 1) * max(largest(b), 1)
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64 if most < 1 << 62 else object


def _as_long(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object:
        scores = np.array([min(max(x, -(1 << 63)), (1 << 63) - 1) for x in scores], np.int64)
    return scores.astype(np.int64)


def whole_numbers(vec: str = "embedding") -> Column:
    """floor(256 * x) per component, or null for vectors that take no part:
    null, or holding a null or non-finite component. Numbers beyond 64 bits are
    cut to them."""
    x = F.transform(F.col(vec), lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~F.coalesce(bad, F.lit(False)) & F.col(vec).isNotNull(), F.transform(x, lambda v: F.floor(v * 256)))


_BLOCK = pa.schema([("block", pa.int32()), ("dims", pa.int32()), ("width", pa.int32()), ("ids", pa.binary()), ("row_ids", pa.binary()), ("vectors", pa.binary())])


def _pack(t: pa.Table) -> pa.Table:
    """All (block, vec_id, row_id, q) rows of a block -> one row of bytes, ``width`` to a component."""
    vecs = t.column("q").combine_chunks()
    lens = np.asarray(vecs.value_lengths())
    m = np.zeros((len(lens), max(1, lens.max())), np.int64)
    m[np.arange(m.shape[1]) < lens[:, None]] = np.asarray(vecs.flatten())
    width = next(w for w in (1, 2, 4, 8) if -1 << 8 * w - 1 <= m.min() and m.max() < 1 << 8 * w - 1)
    as_bytes = lambda c: t.column(c).to_numpy().astype(np.int64).tobytes()
    row = (t.column("block")[0].as_py(), m.shape[1], width, as_bytes("vec_id"), as_bytes("row_id"), m.astype(f"i{width}").tobytes())
    return pa.table([pa.array([c], f.type) for c, f in zip(row, _BLOCK)], schema=_BLOCK)


def _blocks(vectors: DataFrame, count: int, name: str) -> DataFrame:
    """``vectors`` dealt by hash into ``count`` blocks, one row each."""
    dealt = vectors.select(F.pmod(F.xxhash64("row_id"), F.lit(count)).cast("int").alias("block"), "vec_id", "row_id", "q")
    return stored(dealt.groupBy("block").applyInArrow(_pack, "block int, dims int, width int, ids binary, row_ids binary, vectors binary"), name)


def _open(blocks: pa.Table, r: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, row_ids, vectors) of a block."""
    get = lambda c: blocks.column(c)[r].as_py()
    vectors = np.frombuffer(get("vectors"), f"i{get('width')}").reshape(-1, get("dims"))
    return np.frombuffer(get("ids"), np.int64), np.frombuffer(get("row_ids"), np.int64), vectors


def _wide(m: np.ndarray, dims: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, dims - m.shape[1]))) if m.shape[1] < dims else m


def _cell(k: int):
    """The k best of a band's shards for each query of a group of blocks."""

    def run(shards: pa.Table, queries: pa.Table) -> pa.Table:
        blocks = [_open(queries, r) for r in range(queries.num_rows)]
        none = np.zeros(0, np.int64)
        best = [[(none, none)] * len(ids) for ids, _, _ in blocks]  # (ids, scores) of each query, the best first
        for r in range(shards.num_rows):
            held, lists = None, None  # the dimensions and kind of numbers of the lists at hand
            ids, _, m = _open(shards, r)
            for (q_ids, _, qs), own in zip(blocks, best):
                dims, kind = max(qs.shape[1], m.shape[1]), exact_kind(qs, m)
                if (dims, kind) != held:
                    held, lists = (dims, kind), SortedLists(ids, _wide(m, dims), kind)
                for i, x in enumerate(_wide(qs, dims).astype(kind)):
                    had, scores = own[i]
                    # the lowest long may stand for any lower score
                    least = int(scores[-1]) if len(scores) == k and scores[-1] > -1 << 63 else None
                    more, new = lists.top(x, q_ids[i], k, least)
                    if len(more):
                        had, scores = np.concatenate([had, more]), np.concatenate([scores, _as_long(new)])
                        keep = np.lexsort((had, ~scores))[:k]
                        own[i] = had[keep], scores[keep]
        many = [len(i) for own in best for i, _ in own]
        joined = lambda parts: np.concatenate([none, *parts])
        return pa.table({
            "query_id": np.repeat(joined(b[0] for b in blocks), many), "query_row": np.repeat(joined(b[1] for b in blocks), many),
            "vec_id": joined(i for own in best for i, _ in own), "score": joined(s for own in best for _, s in own),
        })

    return run


def top_k(vectors: DataFrame, is_query, k: int = K, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's k best other rows.

    ``vectors``: (vec_id, embedding); ``is_query``: a condition on vec_id. Rows
    with a null vec_id, or a vector that is null or holds a null or non-finite
    component, take no part. Rows that share the query's vec_id are its own.
    A repeated query row is answered once per row; repeated candidates rank
    each. Missing trailing components count as 0. Fewer than k candidates:
    all are returned; an empty table gives no rows. Scores are exact at any
    size of component; a score beyond 64 bits is given as the nearest long.
    """
    usable = stored(
        vectors.where("vec_id is not null").select("vec_id", whole_numbers().alias("q")).where("q is not null")
        .withColumn("row_id", F.monotonically_increasing_id()),
        "vectors",
    )
    n_shards = partitions_for(usable.count(), shard_rows)
    shards = _blocks(usable, n_shards, "shards")
    asked = usable.where(is_query)
    n_blocks = partitions_for(asked.count(), query_rows)
    queries = _blocks(asked, n_blocks, "queries")
    # every group of blocks of queries meets every band of shards once, in a cell
    band = min(BAND_SHARDS, partitions_for(n_shards, CELLS))
    n_bands, n_groups = partitions_for(n_shards, band), partitions_for(n_blocks, GROUP_BLOCKS)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    per = lambda n: F.floor(F.col("block") / n).cast("int")
    cells = lambda df: df.repartition(min(2 * n_bands * n_groups, MOST_TASKS), "band", "group").groupBy("band", "group")
    found = (
        cells(shards.withColumns({"band": per(band), "group": every(n_groups)}))
        .cogroup(cells(queries.withColumns({"group": per(GROUP_BLOCKS), "band": every(n_bands)})))
        .applyInArrow(_cell(k), "query_id long, query_row long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op8_threshold_topk(spark, sf_dir):
    """The 5 best of every row whose vec_id is divisible by 50."""
    from ticklake.llm.common import table

    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0)


ORACLE_SQL = f"""
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, a.r, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % {QUERY_EVERY} = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT query_id, row_number() OVER (PARTITION BY query_id, r ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
WHERE rank <= {K}"""
