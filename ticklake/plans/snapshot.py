"""As-of reads of marts: snapshots that store changed dates only.

A snapshot of a mart is a small map, one row per date of the mart, that names the
folder holding that date's rows:

* ``<path>/data/write=<id>/part=<date>``: the rows of the dates that one
  snapshot changed (a mart without minutes is one part);
* ``<path>/map/snapshot_ts=<t>``: ``(part, write)`` with each part's fingerprint;
* ``<path>/empty``: the mart's columns.

``append_snapshot`` fingerprints every date in one hash aggregate and writes the
dates that the newest earlier snapshot does not hold alike, so storage grows with
the changed dates. Folders are never rewritten; the map is written last, so a
crash in between leaves a folder that nothing names. ``read_as_of`` joins the map
of the chosen snapshot (one row per date, broadcast) with the data, and dynamic
partition pruning reads only the folders named.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ticklake.sources.lake import matches

SNAPSHOT_COL = "snapshot_ts"
PART_COLS = ("write", "part")
# The part of a mart that has no minutes, and of rows without one.
WHOLE = "whole"
_MAP = f"part string, n_rows long, sum_a decimal(38,0), sum_b decimal(38,0), write string, {SNAPSHOT_COL} timestamp"
_PRINT = ("n_rows", "sum_a", "sum_b")


def _part(mart: DataFrame) -> Column:
    if "minute_bucket" not in mart.columns:
        return F.lit(WHOLE)
    return F.coalesce(F.to_date("minute_bucket").cast("string"), F.lit(WHOLE))


def _fingerprints(mart: DataFrame) -> DataFrame:
    """Row count and two sums of 64-bit row hashes per part: the same rows in any
    order give the same values (equal values of unequal rows: about 2^-128)."""
    nulls = [F.col(c).isNull() for c in mart.columns]  # a hash passes over nulls
    sums = [
        F.sum(F.xxhash64(F.lit(seed), *mart.columns, *nulls).cast("decimal(38,0)")).alias(name)
        for seed, name in ((1, "sum_a"), (2, "sum_b"))
    ]
    return mart.groupBy(_part(mart).alias("part")).agg(F.count(F.lit(1)).alias("n_rows"), *sums)


def _map(spark: SparkSession, path: str, as_of) -> DataFrame:
    """The map of the newest snapshot at or before ``as_of`` (a row per part)."""
    if not matches(spark, f"{path}/map/{SNAPSHOT_COL}=*"):
        return spark.createDataFrame([], _MAP)
    maps = spark.read.schema(_MAP).parquet(f"{path}/map").where(F.col(SNAPSHOT_COL) <= F.lit(str(as_of)).cast("timestamp"))
    chosen = maps.agg(F.max(SNAPSHOT_COL).alias(SNAPSHOT_COL))
    return maps.join(F.broadcast(chosen), SNAPSHOT_COL).where(F.col("part").isNotNull())


def append_snapshot(mart: DataFrame, path: str, snapshot_ts) -> int:
    """Record ``mart`` as the snapshot of ``snapshot_ts``; returns the dates written.

    Recording the same ``snapshot_ts`` again replaces that snapshot and no other.
    ``mart`` is read twice: pass a stored one.
    """
    spark, path, write = mart.sparkSession, path.rstrip("/"), f"w{uuid.uuid4().hex}"
    known = _map(spark, path, snapshot_ts).select("part", *(F.col(c).alias(f"old_{c}") for c in _PRINT), F.col("write").alias("old_write"))
    alike = [F.col(c).eqNullSafe(F.col(f"old_{c}")) for c in _PRINT]
    held = F.when(alike[0] & alike[1] & alike[2], F.col("old_write"))
    now = _fingerprints(mart).join(known, "part", "left").select("part", *_PRINT, held.alias("write")).collect()  # one row per date
    changed = [r.part for r in now if r.write is None]
    if not matches(spark, f"{path}/empty"):
        mart.limit(0).write.mode("overwrite").parquet(f"{path}/empty")
    if changed:
        (
            mart.withColumn("part", _part(mart)).where(F.col("part").isin(changed)).hint("rebalance", "part")
            .write.partitionBy("part").parquet(f"{path}/data/write={write}")
        )
    at = F.lit(str(snapshot_ts)).cast("timestamp")
    rows = [(r.part, r.n_rows, r.sum_a, r.sum_b, r.write or write) for r in now] + [(None,) * 5]  # a snapshot may hold no row
    (
        spark.createDataFrame(rows, _MAP.rsplit(",", 1)[0]).withColumn(SNAPSHOT_COL, at).coalesce(1)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(SNAPSHOT_COL).parquet(f"{path}/map")
    )
    return len(changed)


def read_as_of(spark: SparkSession, path: str, as_of) -> DataFrame:
    """Rows of the newest snapshot with ``snapshot_ts <= as_of``; none if there is no
    such snapshot."""
    path = path.rstrip("/")
    empty = spark.read.parquet(f"{path}/empty")
    schema = empty.schema
    for c in PART_COLS:
        schema = schema.add(c, StringType())
    if not matches(spark, f"{path}/data/write=*"):
        return empty.withColumn(SNAPSHOT_COL, F.lit(None).cast("timestamp"))
    named = _map(spark, path, as_of).select(*PART_COLS, SNAPSHOT_COL)
    return spark.read.schema(schema).parquet(f"{path}/data").join(F.broadcast(named), list(PART_COLS)).drop(*PART_COLS)
