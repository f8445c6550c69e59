"""Resharding by minimum-cost flow (operator 12).

A sharded dataset is a folder tree ``shard=K/part-….parquet``; its files are the
blocks that move. Rows lie in one struct column ``row``, so no column of theirs
can clash with the layout.

1. ``inventory`` scans the old shards once: bytes and rows per file.
2. ``plan_transfers`` solves a minimum-cost flow from old shard sizes to new
   capacities: a byte that stays costs nothing, a byte that moves costs one (old
   shards reach other new ones through a hub, so the network has one arc a shard,
   not one a pair). Its input and output are one row per shard.
3. Each old shard's byte line is cut by its flows, what stays first. A file inside
   one cut is a block that stays, untouched, or moves whole. Only files that
   straddle a cut are split row by row, each row (largest first) going to the part
   that still needs most; there is at most one such file per cut.
4. Only the affected files are read and written again. The new dataset is the
   manifest of untouched files plus the new ones.

Text moves without a shuffle except in the few split files. Files are bounded by
``FILE_ROWS`` rows and by the reader's split size, so no task or group holds more
than one file of a hot shard.

Defined results: a null text has size 1 and CRC 0, empty text likewise; rows of a
null shard lie in shard 0; repeated rows, equal texts and null ids are rows
like any other; an empty table has no rows; other columns are carried unchanged.
"""

from __future__ import annotations

import heapq
from collections import deque
from typing import NamedTuple
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ticklake.llm.common import stored, table
from ticklake.session import scratch_path

SHARDS = 8
FILE_ROWS = 200_000
BROADCAST_FILES = 100_000  # rows (path, shard) of moved files; a shuffle join beyond it


class Shards(NamedTuple):
    """A sharded dataset: ``root`` and the files of it that count (None: all), then
    the folder of files written since (None: none)."""

    schema: StructType
    root: str
    files: list[str] | None = None
    added: str | None = None


def row_size(text: Column) -> Column:
    """UTF-8 bytes of the text plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def write_shards(rows: DataFrame, shard: Column, root: str) -> Shards:
    """``rows`` as files under ``root/shard=K`` (null: 0); no shuffle, each task writes its own."""
    row = F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("row")
    laid = rows.select(row, F.coalesce(shard.cast("int"), F.lit(0)).alias("shard"))
    _write(laid, root)
    return Shards(laid.select("row").schema, root)


def _write(rows: DataFrame, root: str) -> None:
    rows.write.partitionBy("shard").option("maxRecordsPerFile", FILE_ROWS).option("compression", "zstd").parquet(root)


def _read(spark: SparkSession, schema: StructType, root: str, files: list[str] | None = None) -> DataFrame:
    """``(row, shard, file, place)`` of the files given (all, if None)."""
    whole = StructType([*schema.fields, StructField("shard", IntegerType())])
    found = spark.read.schema(whole).option("basePath", root).parquet(*([root] if files is None else files))
    return found.select(
        "row", "shard", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place")
    )


def read_shards(spark: SparkSession, shards: Shards) -> DataFrame:
    """``(row, shard, file, place)`` of every row of the dataset."""
    parts = []
    if shards.files is None or shards.files:
        parts.append(_read(spark, shards.schema, shards.root, shards.files))
    if shards.added:
        parts.append(_read(spark, shards.schema, shards.added))
    if not parts:
        whole = StructType([*shards.schema.fields]).add("shard", "int").add("file", "string").add("place", "long")
        return spark.createDataFrame([], whole)
    return parts[0] if len(parts) == 1 else parts[0].union(parts[1])


def inventory(rows: DataFrame, size: Column) -> DataFrame:
    """``(shard, file, rows, bytes)``: one row per file."""
    return rows.groupBy("shard", "file").agg(F.count("*").alias("rows"), F.sum(size).alias("bytes"))


def even_capacities(total: int, shards: int) -> dict[int, int]:
    return {k: total // shards + (k < total % shards) for k in range(shards)}


def plan_transfers(sizes: dict[int, int], capacity: dict[int, int]) -> list[tuple[int, int, int]]:
    """``(old shard, new shard, bytes)`` that fill the capacities and move the fewest
    bytes; entries with equal shards stay.

    Successive shortest paths; each augmentation fills an arc, so their number is
    bounded by the shards, whatever their sizes. Capacities must hold all sizes.
    """
    head, room, cost, arcs = [], [], [], {}

    def arc(a, b, many, price):
        for u, v, m, p in ((a, b, many, price), (b, a, 0, -price)):
            arcs.setdefault(u, []).append(len(head))
            head.append(v)
            room.append(m)
            cost.append(p)
        return len(head) - 2

    total = sum(sizes.values())
    stay, leave, enter = {}, {}, {}
    for i, many in sizes.items():
        arc("from", ("old", i), many, 0)
        if i in capacity:
            stay[i] = arc(("old", i), ("new", i), many, 0)
        leave[i] = arc(("old", i), "hub", many, 1)
    for j, many in capacity.items():
        enter[j] = arc("hub", ("new", j), many, 0)
        arc(("new", j), "to", many, 0)
    sent = 0
    while sent < total:
        best, by, queue = {"from": 0}, {}, deque(["from"])
        while queue:
            u = queue.popleft()
            for e in arcs[u]:
                v = head[e]
                if room[e] and best[u] + cost[e] < best.get(v, float("inf")):
                    best[v], by[v] = best[u] + cost[e], e
                    queue.append(v)
        if "to" not in by:
            raise ValueError(f"the new shards hold {sent} of {total} bytes")
        path, v = [], "to"
        while v != "from":
            path.append(by[v])
            v = head[by[v] ^ 1]
        many = min(room[e] for e in path)
        for e in path:
            room[e] -= many
            room[e ^ 1] += many
        sent += many
    flow = lambda e: room[e ^ 1]
    out = [(i, i, flow(e)) for i, e in stay.items()]
    wanted = deque([j, flow(e)] for j, e in enter.items() if flow(e))
    for i, e in leave.items():  # what passes the hub, in order
        many = flow(e)
        while many:
            step = min(many, wanted[0][1])
            out.append((i, wanted[0][0], step))
            many, wanted[0][1] = many - step, wanted[0][1] - step
            if not wanted[0][1]:
                wanted.popleft()
    return sorted(x for x in out if x[2])


def _split(t: pa.Table) -> pa.Table:
    """Rows of one file to its parts: largest row first, to the part that needs most."""
    size, place = t.column("size").to_numpy(), t.column("place").to_numpy()
    heap = [(-x["need"], x["to"]) for x in t.column("needs")[0].as_py()]
    heapq.heapify(heap)
    to = np.zeros(len(size), np.int32)
    for at in np.lexsort((place, -size)):
        need, part = heap[0]
        to[at] = part
        heapq.heapreplace(heap, (need + int(size[at]), part))
    return pa.table({"file": t.column("file"), "place": t.column("place"), "to": pa.array(to)})


def reshard(spark: SparkSession, old: Shards, size: Column, shards: int = SHARDS) -> Shards:
    """``old`` in ``shards`` shards of near-equal bytes, moving the fewest bytes.

    ``size``: bytes of a row, an expression over ``row``.
    """
    rows = read_shards(spark, old)
    files = stored(inventory(rows, size), "inventory")
    # one row per old shard, then one per transfer: bounded by the shards
    sizes = {r[0]: int(r[1]) for r in files.groupBy("shard").agg(F.sum("bytes")).collect()}
    if not sizes:
        return old
    flows = plan_transfers(sizes, even_capacities(sum(sizes.values()), shards))
    cuts, end = [], {}
    for i, j, many in sorted(flows, key=lambda x: (x[0], x[0] != x[1], x[1])):
        cuts.append((i, j, end.get(i, 0), end.get(i, 0) + many))
        end[i] = cuts[-1][3]
    line = Window.partitionBy("shard").orderBy("file")
    laid = files.withColumn("hi", F.sum("bytes").over(line)).withColumn("lo", F.col("hi") - F.col("bytes"))
    parts = (
        laid.join(spark.createDataFrame(cuts, "shard int, to int, cut_lo long, cut_hi long"), "shard")
        .where("cut_lo < hi and lo < cut_hi")
        .groupBy("shard", "file")
        .agg(F.collect_list(F.struct("to", (F.least("hi", "cut_hi") - F.greatest("lo", "cut_lo")).alias("need"))).alias("needs"))
    )
    parts = stored(parts, "transfers")
    one = F.size("needs") == 1
    stays = one & (F.col("needs")[0]["to"] == F.col("shard"))
    whole, split = parts.where(one & ~stays), parts.where(~one)
    moved = []
    if paths := _paths(whole):
        to = whole.select("file", F.col("needs")[0]["to"].alias("to"))
        to = F.broadcast(to) if len(paths) <= BROADCAST_FILES else to
        moved.append(_files(spark, old, paths).join(to, "file").select("row", F.col("to").alias("shard")))
    if paths := _paths(split):
        cut = _files(spark, old, paths)
        to = (
            cut.select("file", "place", size.alias("size")).join(split.select("file", "needs"), "file")
            .groupBy("file").applyInArrow(_split, "file string, place long, to int")
        )
        moved.append(cut.join(to, ["file", "place"]).select("row", F.col("to").alias("shard")))
    kept = _paths(parts.where(stays))
    if not moved:
        return old._replace(files=kept)
    added = scratch_path(spark, "shards")
    _write(moved[0] if len(moved) == 1 else moved[0].union(moved[1]), added)
    return Shards(old.schema, old.root, kept, added)


def _paths(files: DataFrame) -> list[str]:
    """Paths of files: the manifest, as any reader of the dataset gets it."""
    return sorted(unquote(r[0]) for r in files.select("file").collect())


def _files(spark: SparkSession, old: Shards, paths: list[str]) -> DataFrame:
    """Rows of some files of ``old``."""
    return _read(spark, old.schema, old.root, paths)


def slots(rows: DataFrame) -> DataFrame:
    """``rows`` of ``read_shards`` with ``slot``: the place in the shard, gapless from 0.

    Files in order of their path, rows in file order: one count per file, no sort
    of rows.
    """
    files = rows.groupBy("shard", "file").agg(F.count("*").alias("many"))
    line = Window.partitionBy("shard").orderBy("file")
    before = files.select("file", (F.sum("many").over(line) - F.col("many")).alias("before"))
    return rows.join(before, "file").withColumn("slot", F.col("before") + F.col("place")).drop("before")


def op12_flow_resharding(spark, sf_dir):
    """All documents, first in six shards by source, resharded into eight of equal bytes."""
    docs = table(spark, sf_dir, "documents")
    by_source = F.crc32(F.col("source").cast("binary")) % 6
    old = write_shards(docs, by_source, scratch_path(spark, "old-shards"))
    size = row_size(F.col("row.text"))
    found = read_shards(spark, reshard(spark, old, size)).select(
        F.col("row.doc_id").alias("doc_id"), size.alias("size"),
        F.crc32(F.coalesce(F.col("row.text"), F.lit("")).cast("binary")).alias("text_crc32"), "shard", "file", "place",
    )
    return slots(found).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
