"""Connected components of an edge table, as Spark joins.

Hash-min with pointer jumping. Edge and label tables are written each
round (lineage cut, recovery from files), and every join has plain
exchanges on both sides, so AQE can split a hub that a third of all edges
share. Nothing but the count of changed labels reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``(u, v)`` long pairs -> ``(node, component)``; component is the smallest
    node reachable. Only nodes that occur in an edge are returned. Self-edges,
    repeated edges and an empty table are fine; null ends are dropped."""
    pairs = edges.where("u is not null and v is not null and u <> v")
    both = stored(
        pairs.select("u", "v").union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(),
        "edges",
    )
    labels = stored(
        both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("component")),
        "labels",
    )
    while True:
        seen = (
            both.join(labels.withColumnRenamed("node", "v"), "v")
            .select(F.col("u").alias("node"), "component")
            .union(labels)
            .groupBy("node")
            .agg(F.min("component").alias("near"))
        )
        near = stored(seen, "near")
        # pointer jump: the label of my label
        hop = near.select(F.col("node").alias("near"), F.col("near").alias("far"))
        jumped = near.join(hop, "near").select("node", F.least("near", "far").alias("component"))
        new = stored(jumped, "labels")
        if _same(labels, new):
            return new
        labels = new


def _same(a: DataFrame, b: DataFrame) -> bool:
    """Labels only fall, so equal sums mean that no label moved."""
    total = lambda d: d.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
    return total(a) == total(b)
