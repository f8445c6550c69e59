"""Small-file compaction of the lake, beside running writers.

Micro-batch landing writes a file per (pair, date, hour) per trigger.

1. ``plan_compaction`` lists the files and packs the small ones of each directory
   into bins of at most the target size (first fit, largest first). Directories
   without two small files, and large files, are left alone.
2. ``stage_compaction`` reads exactly those files and writes one file per bin.
3. The swap (``sources.files``) moves the new files in and deletes the files that
   were read, by name. Whatever was appended since the listing stays, and a crash
   at any point leaves either the old files or a journal that ``recover`` finishes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.session import configure, scratch_path
from ticklake.schema import TRADE_V1_REQUIRED
from ticklake.sources import files
from ticklake.sources.lake import LAKE_SCHEMA

TARGET_BYTES = 256 << 20
BROADCAST_FILES = 100_000  # plan rows (path, bin) that may be broadcast; a shuffle join beyond it
_SEGMENTS = 4  # pair=, trade_date=, hour=, file


class Staged(NamedTuple):
    """A staged swap: its folder (None: nothing to do), bins and files replaced."""

    swap: str | None
    bins: int
    files: int


def first_fit(lengths: list[int], target: int) -> list[int]:
    """Bin of each length: the first that has room, largest lengths first."""
    room: list[int] = []
    out = [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        b = next((b for b, left in enumerate(room) if left >= lengths[i]), len(room))
        if b == len(room):
            room.append(target)
        room[b] -= lengths[i]
        out[i] = b
    return out


def plan_compaction(spark: SparkSession, root: str, dates: Iterable | None = None, target: int = TARGET_BYTES) -> DataFrame:
    """``(path, length, bin)`` of the files to merge: those under half the target that
    share a bin with another. One group per directory, of file names only."""
    found = files.file_rows(spark, root).withColumn("dir", F.regexp_replace("path", "/[^/]*$", ""))
    if dates is not None:
        day = F.regexp_extract("dir", "/trade_date=([^/]+)/", 1)
        found = found.where(day.isin([str(d) for d in dates]))
    small = found.where(F.col("length") * 2 < target)

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("path", ignore_index=True)
        group["bin"] = first_fit(group["length"].tolist(), target)
        return group[group.groupby("bin")["path"].transform("size") > 1]

    packed = small.groupBy("dir").applyInPandas(pack, "path string, length long, dir string, bin int")
    return packed.select("path", "length", F.concat(F.md5("dir"), F.lit("-"), F.col("bin")).alias("bin"))


def stage_compaction(spark: SparkSession, root: str, dates: Iterable | None = None, target: int = TARGET_BYTES) -> Staged:
    """Write the merged files and the journal of their swap; the lake is unchanged.

    Every bin is one task's file, of at most the target size; rows are sorted by
    trade time. The staged rows must be as many as those of the files read.
    """
    configure(spark)
    base = root.rstrip("/")
    path = scratch_path(spark, "compaction-plan")
    plan_compaction(spark, base, dates, target).write.parquet(path)
    plan = spark.read.parquet(path)
    paths = [r[0] for r in plan.select("path").collect()]  # the manifest of what is read
    if not paths:
        return Staged(None, 0, 0)
    bins = plan.select("bin").distinct().count()
    swap = f"{base}/{files.SWAPS}/{uuid.uuid4().hex[:12]}"
    source = spark.read.schema(LAKE_SCHEMA).option("basePath", base).parquet(*paths)
    keyed = plan.select("bin", files.path_key(F.col("path"), _SEGMENTS).alias("_file"))
    keyed = F.broadcast(keyed) if len(paths) <= BROADCAST_FILES else keyed
    (
        source.select(*TRADE_V1_REQUIRED, files.path_key(F.col("_metadata.file_path"), _SEGMENTS, encoded=True).alias("_file"))
        .join(keyed, "_file").drop("_file")
        .repartition(bins, "bin").sortWithinPartitions("bin", "trade_ts", "trade_id")
        .write.partitionBy("bin").option("compression", "zstd").parquet(f"{swap}/files")
    )
    staged = files.file_rows(spark, f"{swap}/files").select(
        F.col("path").alias("new"), F.regexp_extract("path", "/bin=([^/]+)/", 1).alias("bin")
    )
    kept = spark.read.parquet(f"{swap}/files").count()
    if (there := source.count()) != kept:
        raise RuntimeError(f"compaction staged {kept} of {there} rows")
    old = plan.groupBy("bin").agg(F.sort_array(F.collect_list("path")).alias("old"))
    name = F.concat(F.lit("/compact-"), F.col("bin"), F.lit("-"), F.substring_index("new", "/", -1))
    place = F.concat(F.regexp_replace(F.col("old")[0], "/[^/]*$", ""), name)
    files.commit(spark, base, swap, staged.join(old, "bin").select(F.array("new").alias("new"), F.array(place).alias("place"), "old"))
    return Staged(swap, bins, len(paths))


def compact(spark: SparkSession, root: str, dates: Iterable | None = None, target: int = TARGET_BYTES) -> Staged:
    """Merge the small files of ``dates`` (``None``: every date); swaps that a crash
    left behind are finished first."""
    configure(spark)
    files.recover(spark, root)
    staged = stage_compaction(spark, root, dates, target)
    if staged.swap:
        files.apply(spark, staged.swap)
    return staged
