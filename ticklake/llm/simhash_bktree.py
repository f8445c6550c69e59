"""SimHash near-duplicates through BK-trees (operator 10).

1. ``fingerprints``: one 64-bit SimHash per document, Arrow batches.
2. Equal fingerprints collapse to one node (their smallest doc_id), map-side
   first, so a group of exact copies of any size is one row from here on.
3. Two fingerprints that differ in at most ``radius`` of 64 bits agree on at
   least ``blocks - radius`` of ``blocks`` bit blocks; a node is dealt once
   under every such choice of blocks (15 choices for 6 blocks, radius 4), so
   each link meets under at least one key and only there work is done.
4. Each task holds a shard of keys as a forest of BK-trees: children are keyed
   by their integer Hamming distance to the parent; a query walks down only
   the edges within ``radius`` of its own distance to the node (triangle
   inequality). The walk is level by level over arrays.
   A key with over ``tree_rows`` nodes is cut into chunks and dealt as pairs
   of chunks, so no tree grows without bound and no link is lost.
5. A shard reports stars (node -> smallest node it is connected to there),
   never all pairs; ``graph.components`` joins the stars.

The shard trees travel by shuffle instead of broadcast: all fingerprints of a
corpus have no size bound, so broadcasting them would not scale.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import NO_ID, map_rows, partitions_for, stored
from ticklake.llm.graph import components

SHINGLE = 4
RADIUS = 4
BLOCKS = 6
TREE_ROWS = 4096
SHARD_ROWS = 100_000

_BITS = np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of word shingles as a signed integer; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, 42) for g in grams), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(_BITS[ones * 2 > len(hashes)].sum().astype(np.int64))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp long)`` per row of ``docs`` (columns doc_id, text)."""
    return map_rows(
        docs.select("doc_id", "text"),
        lambda: lambda doc_id, text: (doc_id, fingerprint(text, shingle)),
        "doc_id long, fp long",
    )


def block_masks(blocks: int, radius: int) -> list[int]:
    """Bit masks of every choice of ``blocks - radius`` blocks, as signed longs."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    part = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    masks = [sum(c) for c in combinations(part, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


class BKForest:
    """BK-trees of many groups at once, held in arrays.

    ``group`` (sorted) names the tree of each fingerprint. Built level by
    level: the first item of every slot (parent, distance) becomes its node,
    the rest measure their distance to it and move to that child slot.
    """

    def __init__(self, group: np.ndarray, fp: np.ndarray):
        n = len(fp)
        self.fp = fp
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.zeros(0, np.int64)
        self.root = np.repeat(first, np.diff(np.r_[first, n]))
        slots, kids = [], []
        node = self.root.copy()
        item = np.arange(n)
        item, node = item[item != node], node[item != node]
        while len(item):
            slot = node * 65 + np.bitwise_count(fp[item] ^ fp[node]).astype(np.int64)
            order = np.argsort(slot, kind="stable")
            item, slot = item[order], slot[order]
            head = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
            slots.append(slot[head])
            kids.append(item[head])
            node = np.repeat(item[head], np.diff(np.r_[head, len(item)]))
            left = item != node
            item, node = item[left], node[left]
        self.slot = np.concatenate(slots) if slots else np.zeros(0, np.int64)
        self.kid = np.concatenate(kids) if kids else np.zeros(0, np.int64)
        order = np.argsort(self.slot, kind="stable")
        self.slot, self.kid = self.slot[order], self.kid[order]

    def within(self, query: np.ndarray, radius: int):
        """Yields arrays (query item, found item) at most ``radius`` bits apart."""
        q, node = query, self.root[query]
        while len(q):
            d = np.bitwise_count(self.fp[q] ^ self.fp[node]).astype(np.int64)
            hit = (d <= radius) & (q != node)
            yield q[hit], node[hit]
            low = np.searchsorted(self.slot, node * 65 + np.maximum(d - radius, 0))
            high = np.searchsorted(self.slot, node * 65 + np.minimum(d + radius, 64), side="right")
            many = high - low
            q = np.repeat(q, many)
            at = np.repeat(low - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(len(q))
            node = self.kid[at]


def stars(group: np.ndarray, fp: np.ndarray, rank: np.ndarray, radius: int) -> np.ndarray:
    """For items sorted by ``group``: the index of the item with the smallest
    ``rank`` that each is connected to by links within its group."""
    forest = BKForest(group, fp)
    label = np.arange(len(fp))
    size = np.bincount(forest.root, minlength=len(fp))[forest.root] if len(fp) else label
    # query blocks of a bounded number of (query, node) visits
    block = np.cumsum(size) // 1_000_000
    many = np.flatnonzero(size > 1)
    for b in np.unique(block[many]):
        query = many[block[many] == b]
        for q, found in forest.within(query, radius):
            label = _union(label, q, found)
    roots = _flat(label)
    best = np.full(len(fp), np.iinfo(np.int64).max)
    np.minimum.at(best, roots, rank)
    at_best = np.zeros(len(fp), np.int64)
    is_best = rank == best[roots]
    at_best[roots[is_best]] = np.flatnonzero(is_best)
    return at_best[roots]


def _flat(label: np.ndarray) -> np.ndarray:
    while True:
        up = label[label]
        if np.array_equal(up, label):
            return label
        label = up


def _union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of the pairs (a, b) in a forest of parent pointers that point down."""
    while len(a):
        label = _flat(label)
        ra, rb = label[a], label[b]
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        if not len(a):
            break
        np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))
    return label


def _shard_stars(radius: int):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(t: pa.Table) -> pa.Table:
        key, fp, node = (t.column(c).to_numpy() for c in ("key", "fp", "node"))
        order = np.lexsort((node, key))
        key, fp, node = key[order], fp[order].astype(np.int64).view(np.uint64), node[order]
        to = stars(key, fp, node, radius)
        far = node[to] != node
        return pa.table([pa.array(node[far]), pa.array(node[to][far])], schema=schema)

    return run


def links(nodes: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tree_rows: int = TREE_ROWS) -> DataFrame:
    """Star edges ``(u, v)`` whose components are those of all links.

    ``nodes``: ``(fp long, node long)``, one row per fingerprint.
    """
    masks = F.array(*(F.lit(m) for m in block_masks(blocks, radius)))
    dealt = nodes.select("fp", "node", F.posexplode(masks).alias("choice", "mask")).select(
        F.xxhash64("choice", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"), "fp", "node"
    )
    n_choices = len(block_masks(blocks, radius))
    shards = partitions_for(nodes.count() * n_choices, SHARD_ROWS, 12)
    heavy = stored(
        dealt.groupBy("key").count().where(F.col("count") > tree_rows)
        .select("key", F.ceil(F.col("count") / tree_rows).cast("int").alias("chunks")),
        "heavy",
    )
    run, schema = _shard_stars(radius), "u long, v long"
    light = dealt.join(heavy, "key", "left_anti")
    found = (
        light.withColumn("shard", F.pmod(F.col("key"), F.lit(shards)))
        .groupBy("shard").applyInArrow(run, schema)
    )
    if heavy.take(1):
        chunk = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
        tiles = (
            dealt.join(heavy, "key")
            .withColumn("chunk", chunk)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select("key", "fp", "node", F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"))
        )
        found = found.union(tiles.groupBy("key", "a", "b").applyInArrow(run, schema))
    return found


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row of ``docs``.

    Null and wordless texts have fingerprint zero and link like any other.
    Rows with a null doc_id get a component but never name it: component_id is
    the smallest non-null doc_id reachable, null if there is none. Repeated
    rows are kept; extra columns are ignored; an empty table gives no rows.
    """
    fps = stored(fingerprints(docs, shingle), "fingerprints")
    first = F.coalesce(F.min("doc_id"), F.lit(NO_ID) + F.pmod(F.xxhash64("fp"), F.lit(1 << 61)))
    nodes = stored(fps.groupBy("fp").agg(first.alias("node")), "nodes")
    comp = components(links(nodes, radius))
    named = F.coalesce("component", "node")
    by_fp = stored(
        nodes.join(comp, "node", "left").select("fp", F.when(named < NO_ID, named).alias("component_id")),
        "components",
    )
    return fps.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` with one document of each group: the smallest doc_id.

    Documents without an id cannot be named and all stay. Of the rows that share
    a kept doc_id one per fingerprint stays, so unrelated texts under one id
    are not lost.
    """
    found = stored(simhash_components(docs.select("doc_id", "text"), shingle, radius).where("doc_id = component_id"), "kept")
    ids = found.groupBy("doc_id").agg((F.count("*") > 1).alias("several"))
    # the row travels as one struct, so that no column of it can clash
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "doc_id")
    one = rows.join(ids.where("not several"), "doc_id", "left_semi").select("row")
    several = rows.join(ids.where("several"), "doc_id", "left_semi")
    fp = _fingerprint_udf(shingle)(F.col("row")["text"])
    first = several.groupBy("doc_id", fp.alias("fp")).agg(F.first("row").alias("row")).select("row")
    unnamed = rows.where("doc_id is null").select("row")
    kept = one.unionByName(first).unionByName(unnamed)
    return kept.select(*(F.col("row")[c].alias(c) for c in docs.columns))


def _fingerprint_udf(shingle: int):
    @F.pandas_udf("long")
    def of(text: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in text], dtype="int64")

    return of


def op10_simhash_neardup(spark, sf_dir):
    """One row per document: fingerprint and component."""
    from ticklake.llm.common import table

    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")
