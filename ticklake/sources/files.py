"""Files of a lake as rows, and swaps of files that survive a crash.

A swap replaces named files by new ones and touches no other file, so rows that
a writer adds meanwhile stay. New files are staged under ``<root>/_swaps/<id>``
(hidden from readers, same store); a journal that names old and new files is
renamed into place as the commit; then each entry is applied: new file in, old
files out. ``recover`` applies journals that a crash left behind; an entry can be
applied any number of times. Rows are never missing in between; a reader that
lists the folder during one entry can meet its rows twice.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SWAPS = "_swaps"
# Without a journal a swap folder is work in progress; after so long it was abandoned.
ABANDONED_HOURS = 24
_ENTRY = "new array<string>, place array<string>, old array<string>"


def file_rows(spark: SparkSession, root: str) -> DataFrame:
    """``(path, length)`` of every Parquet file below ``root``; no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    return found.select("path", "length")


def path_key(path: Column, segments: int, encoded: bool = False) -> Column:
    """The last ``segments`` of a path; ``encoded``: of ``_metadata.file_path``, which
    is percent-encoded."""
    if encoded:
        path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.substring_index(path, "/", -segments)


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def remove(spark: SparkSession, folder: str) -> None:
    """Remove one folder of a table, if it is there."""
    fs, path = _fs(spark, folder)
    fs.delete(path(folder), True)


def commit(spark: SparkSession, root: str, swap: str, entries: DataFrame) -> None:
    """Write the journal of swap folder ``swap``: arrays ``(new, place, old)``, the
    staged files, where each goes and what they replace."""
    entries.write.mode("overwrite").parquet(f"{swap}/journal.tmp")
    fs, path = _fs(spark, root)
    if not fs.rename(path(f"{swap}/journal.tmp"), path(f"{swap}/journal")):
        raise OSError(f"cannot commit {swap}")


def apply(spark: SparkSession, swap: str, threads: int = 16) -> int:
    """Apply a committed swap and remove its folder; returns the entries applied.

    An entry some of whose old files are gone before a new file is in place
    was overtaken (its directory was overwritten, or another swap took the
    files): it is dropped.
    """
    fs, path = _fs(spark, swap)

    def one(row) -> bool:
        moves = [(path(n), path(p)) for n, p in zip(row.new, row.place)]
        old = [path(p) for p in row.old]
        if not any(fs.exists(p) for _, p in moves) and not all(fs.exists(x) for x in [*(n for n, _ in moves), *old]):
            return False
        for new, place in moves:
            if not fs.exists(place) and not fs.rename(new, place):
                raise OSError(f"cannot move {new.toString()}")
        for p in old:
            fs.delete(p, False)
        return True

    entries = spark.read.schema(_ENTRY).parquet(f"{swap}/journal")
    with ThreadPoolExecutor(threads) as pool:  # file names only, a few at a time
        done = sum(pool.map(one, entries.toLocalIterator()))
    fs.delete(path(swap), True)
    return done


def replace(spark: SparkSession, base: str, old: list[str], rows: DataFrame, folder: str) -> int:
    """Write ``rows`` as new files of ``folder`` (under ``base``) in place of the files
    ``old``, in one entry of one swap."""
    swap = f"{base.rstrip('/')}/{SWAPS}/{uuid.uuid4().hex[:12]}"
    rows.hint("rebalance").write.parquet(f"{swap}/files")
    new = sorted(r[0] for r in file_rows(spark, f"{swap}/files").select("path").collect())
    place = [f"{folder.rstrip('/')}/fold-{uuid.uuid4().hex[:8]}-{p.rsplit('/', 1)[1]}" for p in new]
    commit(spark, base, swap, spark.createDataFrame([(new, place, sorted(old))], _ENTRY))
    return apply(spark, swap)


def recover(spark: SparkSession, root: str, abandoned_hours: float = ABANDONED_HOURS) -> int:
    """Finish the committed swaps that a crash left under ``root`` and remove
    abandoned stagings; returns the entries applied."""
    fs, path = _fs(spark, root)
    base, done = path(f"{root.rstrip('/')}/{SWAPS}"), 0
    if not fs.exists(base):
        return 0
    for status in fs.listStatus(base):
        swap = status.getPath().toString()
        if fs.exists(path(f"{swap}/journal")):
            done += apply(spark, swap)
        elif time.time() - status.getModificationTime() / 1000 > abandoned_hours * 3600:
            fs.delete(status.getPath(), True)
    return done
