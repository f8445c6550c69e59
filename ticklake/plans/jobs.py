"""Job entry points (what a scheduler runs).

* ``init_catalog``  — namespaces + external table over the lake + listing
* ``refresh_marts`` — staging over the lake, one-pass rebuild of the marts
* ``refresh_dates`` — incremental: touched dates only + merged health
* ``nightly_checks`` — all data-quality checks; raises on any failure
* ``report``        — the titled top-5 reads of every mart
* ``migrate_unkeyed`` — copy an un-keyed lake into the keyed layout

Each reads the shared lake/mart roots given by the caller; nothing is
written to machine-local folders.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ticklake.operators import quality, serving
from ticklake.operators.staging import dedupe_trades, stg_trades
from ticklake.plans import refresh as R
from ticklake.schema import NOT_NULL_RULES
from ticklake.session import configure
from ticklake.sources import catalog
from ticklake.sources.lake import create_external_table, read_lake, read_unkeyed, write_lake


def init_catalog(spark: SparkSession, lake_root: str, catalog_root: str) -> list[tuple[str, str]]:
    """Create ext/stg/marts, (re)create ``ext.trades`` and the view
    ``stg.stg_trades`` over it, and list ``ext``."""
    configure(spark)
    catalog.ensure_namespaces(spark, catalog.NAMESPACES, location_root=catalog_root)
    catalog.create_staging_view(spark, create_external_table(spark, lake_root, "ext", "trades"))
    return catalog.list_tables(spark, "ext")


def migrate_unkeyed(spark: SparkSession, src_root: str, lake_root: str, subdir: str = "trades") -> None:
    """Copy an un-keyed lake (``pair/yyyy-MM-dd/HH`` directories) into the
    keyed layout. Partition values are re-derived from the rows, which
    also repairs files that sit in the wrong directory."""
    configure(spark)
    write_lake(read_unkeyed(spark, src_root, subdir), lake_root)


def staging_view(spark: SparkSession, lake_root: str, start=None, end=None, dedupe: bool = False) -> DataFrame:
    """``stg_trades`` over the lake (optionally a time range, pruned); ``dedupe``
    keeps one row per trade key."""
    stg = stg_trades(read_lake(spark, lake_root, start=start, end=end))
    if dedupe:
        stg = dedupe_trades(stg)
    catalog.create_view(stg, "stg_trades")
    return stg


def refresh_marts(spark: SparkSession, lake_root: str, marts_root: str, select: Iterable[str] | None = None,
                  as_of=None, db: str | None = "marts", snapshot_ts=None, dedupe: bool = False) -> dict[str, str]:
    """Rebuild the selected marts (all by default) from the whole lake.

    Delivery is at-least-once; ``dedupe`` counts every trade once.
    """
    configure(spark)
    return R.refresh(spark, staging_view(spark, lake_root, dedupe=dedupe), marts_root, select=select, as_of=as_of,
                     db=db, snapshot_ts=snapshot_ts)


def refresh_dates(spark: SparkSession, lake_root: str, marts_root: str, dates: Iterable,
                  as_of=None, lookback: str = "5 minutes", db: str | None = None, dedupe: bool = False) -> dict[str, str]:
    """Incremental refresh: rebuild only ``dates`` and merge the health report.

    * minute marts: the touched dates' partitions are read (partition
      pruning), aggregated in one pass and swapped in by dynamic
      partition overwrite — other dates are neither read nor rewritten;
    * health: recent counts come from a pruned read of the partitions
      at or after ``as_of - lookback``; the per-pair newest trade/ingest
      times are the max of the previous report, the touched dates and
      the recent read. History is never rescanned.

    Equal to a full ``refresh_marts`` when the untouched dates did not
    change since the previous refresh. With ``db`` the registered tables take
    up the new dates and replaced files.
    """
    import datetime as dt

    from pyspark.sql import functions as F

    from ticklake.operators import marts as M
    from ticklake.session import scratch_path

    configure(spark)
    if as_of is None:
        as_of = spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    ds = sorted({str(d) for d in dates})
    once = dedupe_trades if dedupe else (lambda stg: stg)
    touched = once(stg_trades(read_lake(spark, lake_root).where(F.col("trade_date").isin(*[F.lit(d).cast("date") for d in ds]))))
    stats_path = scratch_path(spark, "minute-stats")
    M.minute_stats(touched, (*M.ALL_MINUTE, M.HEALTH), as_of=as_of).write.mode("overwrite").parquet(stats_path)
    stats = spark.read.parquet(stats_path)
    paths = R.write_marts(R.marts_from_stats(stats, list(R.MINUTE_MARTS), as_of), marts_root, dates_only=True)

    since = dt.datetime.fromisoformat(str(as_of)) - _interval(lookback)
    now = M.as_of_col(as_of)
    threshold = now - F.expr(f"INTERVAL {lookback}")
    recent = once(stg_trades(read_lake(spark, lake_root, start=since))).groupBy("pair").agg(
        F.count_if(F.col("trade_ts_utc") >= threshold).alias("n"),
        F.max("trade_ts_utc").alias("mt"), F.max("ingested_at_utc").alias("mi"))
    parts = [recent, stats.groupBy("pair").agg(
        F.lit(0).cast("bigint").alias("n"), F.max("max_trade_ts_utc").alias("mt"),
        F.max("max_ingested_at_utc").alias("mi"))]
    health_path = f"{marts_root.rstrip('/')}/{R.HEALTH_MART}"
    prev = _read_if_exists(spark, health_path)
    if prev is not None:
        parts.append(prev.select("pair", F.lit(0).cast("bigint").alias("n"),
                                 F.col("max_trade_ts_utc").alias("mt"), F.col("max_ingested_at_utc").alias("mi")))
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    per_pair = merged.groupBy("pair").agg(
        F.sum("n").alias("trades_last_5m"), F.max("mt").alias("max_trade_ts_utc"),
        F.max("mi").alias("max_ingested_at_utc"))
    staged = scratch_path(spark, "health")
    M._health_project(per_pair, as_of).write.mode("overwrite").parquet(staged)
    R.materialize(spark.read.parquet(staged), health_path, R.HEALTH_MART)
    paths[R.HEALTH_MART] = health_path
    if db:
        for name, path in paths.items():
            R.update_table(spark, db, name, path, location_root=f"{marts_root.rstrip('/')}/_catalog")
    return paths


def _interval(text: str):
    import datetime as dt

    n, unit = text.split()
    return dt.timedelta(**{unit if unit.endswith("s") else unit + "s": int(n)})


def _read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(path)
    except AnalysisException:  # no previous report yet
        return None


def nightly_checks(spark: SparkSession, lake_root: str, db: str = "marts", dedupe_key: str = "trade_key") -> DataFrame:
    """Run every not-null rule plus trade-key uniqueness; raise on failures.

    Returns the check table (one row per check) when all pass.
    """
    configure(spark)
    tables = {"stg_trades": staging_view(spark, lake_root)}
    for name in NOT_NULL_RULES:
        if name != "stg_trades" and spark.catalog.tableExists(f"{db}.{name}"):
            tables[name] = serving.mart_table(spark, name, db)
    checks = quality.run_checks(tables, NOT_NULL_RULES, unique_keys={"stg_trades": dedupe_key})
    quality.assert_passed(checks)
    return checks


def report(spark: SparkSession, db: str = "marts") -> dict[str, DataFrame]:
    serving.require_marts(spark, db)
    return serving.latest_of_each_mart(spark, db)
