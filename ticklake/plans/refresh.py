"""Mart refresh: model registry, selection and materialisation.

A full refresh scans staging ONCE and shuffles it ONCE: all four minute
marts come from a single ``groupBy(pair, minute_bucket)`` (``minute_stats``)
and the health mart is rolled up from that minute table. The minute
table is written to reliable storage first, so lineage back to the raw
trades is cut: a lost executor re-reads a small table, not the lake.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.operators import marts as M
from ticklake.session import configure, scratch_path
from ticklake.sources import files
from ticklake.sources.lake import matches

# Model graph: name -> (measure groups needed in minute_stats, projection).
MINUTE_MARTS = {
    "fct_trades_1m": ((M.TRADES,), M.trades_from_stats),
    "fct_candles_1m": ((M.CANDLES,), M.candles_from_stats),
    "fct_orderflow_1m": ((M.ORDERFLOW,), M.orderflow_from_stats),
    "fct_ingestion_latency_1m": ((M.LATENCY,), M.latency_from_stats),
}
HEALTH_MART = "fct_pipeline_health_5m"
# Storage partition of the minute marts: the UTC date of minute_bucket.
MART_DATE = "trade_date"
ALL_MARTS = (*MINUTE_MARTS, HEALTH_MART)
MODELS = ("stg_trades", *ALL_MARTS)
# Every mart depends on the staging view only.
DEPENDS_ON = {m: ("stg_trades",) for m in ALL_MARTS}


def resolve(select: Iterable[str] | None) -> list[str]:
    """Marts to build for a selection (``None`` = all), in model order."""
    if select is None:
        return list(ALL_MARTS)
    wanted = set(select)
    unknown = wanted - set(MODELS)
    if unknown:
        raise ValueError(f"unknown models: {sorted(unknown)}")
    return [m for m in ALL_MARTS if m in wanted]


def _groups(selected: Sequence[str]) -> tuple[str, ...]:
    g: list[str] = []
    for m in selected:
        if m in MINUTE_MARTS:
            g += MINUTE_MARTS[m][0]
        elif m == HEALTH_MART:
            g.append(M.HEALTH)
    return tuple(dict.fromkeys(g))


def marts_from_stats(stats: DataFrame, selected: Sequence[str], as_of=None) -> dict[str, DataFrame]:
    out = {}
    for m in selected:
        if m in MINUTE_MARTS:
            out[m] = MINUTE_MARTS[m][1](stats)
        elif m == HEALTH_MART:
            out[m] = M.health_from_stats(stats, as_of)
    return out


def build_marts(stg: DataFrame, as_of=None, select: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """Lazy DataFrames of the selected marts, all over one ``minute_stats``.

    Each mart used on its own prunes the aggregate to its measures. When
    several marts feed ONE query their branches share the shuffle only if
    they prune to the same aggregate (exchange reuse), so multi-mart jobs
    use ``refresh``, which materialises the minute table once.
    """
    selected = resolve(select)
    stats = M.minute_stats(stg, _groups(selected), as_of=as_of)
    return marts_from_stats(stats, selected, as_of)


def materialized_stats(spark: SparkSession, stg: DataFrame, groups=(*M.ALL_MINUTE, M.HEALTH),
                       as_of=None) -> DataFrame:
    """``minute_stats`` written once to the shared checkpoint folder and read
    back: the one aggregate pass over the trades, with lineage cut."""
    path = scratch_path(spark, "minute-stats")
    M.minute_stats(stg, groups, as_of=as_of).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def refresh(
    spark: SparkSession,
    stg: DataFrame,
    root: str,
    select: Iterable[str] | None = None,
    as_of=None,
    db: str | None = None,
    snapshot_ts: str | None = None,
) -> dict[str, str]:
    """Rebuild the selected marts under ``root/<mart>`` (full rebuild).

    For a large lake prefer ``jobs.refresh_dates``: it rebuilds only the
    dates that received trades and merges the health report.

    * ``as_of``: the health report's "now" (default: the job's start).
    * ``db``: also register each mart as an external table ``db.<mart>``.
    * ``snapshot_ts``: also append this refresh to ``root/_snapshots/<mart>``
      partitioned by ``snapshot_ts`` (as-of reads, ``plans.snapshot``).

    Returns mart name -> path.
    """
    configure(spark)
    selected = resolve(select)
    as_of = as_of if as_of is not None else spark.range(1).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    stats = materialized_stats(spark, stg, _groups(selected), as_of)
    built = marts_from_stats(stats, selected, as_of)
    paths = write_marts(built, root)
    for name, path in paths.items():
        if db:
            register_table(spark, db, name, path, location_root=f"{root.rstrip('/')}/_catalog")
        if snapshot_ts is not None:
            from ticklake.plans.snapshot import append_snapshot

            append_snapshot(read_mart(spark, path), f"{root.rstrip('/')}/_snapshots/{name}", snapshot_ts)
    return paths


def write_marts(built: dict[str, DataFrame], root: str, dates_only: bool = False) -> dict[str, str]:
    """Write mart DataFrames under ``root/<mart>``.

    The writes are independent small jobs over one minute table, so they
    are submitted together (their scheduling and I/O overlap).
    """
    paths = {name: f"{root.rstrip('/')}/{name}" for name in built}
    with ThreadPoolExecutor(max_workers=max(1, len(built))) as pool:
        futures = [pool.submit(materialize, df, paths[name], name, dates_only) for name, df in built.items()]
        for f in futures:
            f.result()
    return paths


def materialize(df: DataFrame, path: str, name: str | None = None, dates_only: bool = False) -> None:
    """Store a mart.

    Minute marts are partitioned by their bucket's UTC date
    (``trade_date``); rows are rebalanced by date, so a date is one file or a
    few of the advisory size, however many tasks aggregated it. Dates are
    swapped in when the new files are complete (dynamic partition
    overwrite): the mart is never empty for its readers. A full rebuild then
    removes dates that no longer occur; ``dates_only`` leaves other dates
    alone. The per-pair health report is always replaced whole, by a swap of
    files: it is never missing for its readers.
    """
    if name in MINUTE_MARTS:
        dated = df.withColumn(MART_DATE, F.to_date("minute_bucket"))
        (
            dated.hint("rebalance", MART_DATE)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(MART_DATE)
            .parquet(path)
        )
        if not dates_only:
            _remove_other_dates(dated, path)
        return
    spark = df.sparkSession
    files.recover(spark, path)
    old = [r[0] for r in files.file_rows(spark, path).select("path").collect()] if matches(spark, path) else []
    if old:
        files.replace(spark, path, old, df, path)
    else:
        df.write.mode("overwrite").parquet(path)


def _remove_other_dates(dated: DataFrame, path: str) -> None:
    """Delete the date directories of ``path`` that ``dated`` has no row for."""
    spark = dated.sparkSession
    base = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    there = {s.getPath().getName(): s.getPath() for s in fs.listStatus(base) if s.isDirectory()}
    kept = {f"{MART_DATE}={r[0]}" for r in dated.select(MART_DATE).distinct().collect()}  # one value per day
    for name, at in there.items():
        if name.startswith(f"{MART_DATE}=") and name not in kept:
            fs.delete(at, True)


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """A stored mart with its published columns (storage partition dropped)."""
    df = spark.read.parquet(path)
    return df.drop(MART_DATE) if MART_DATE in df.columns else df


def register_table(spark: SparkSession, db: str, name: str, path: str,
                   location_root: str | None = None) -> None:
    """(Re)register ``db.name`` as an external Parquet table at ``path``."""
    from ticklake.sources.catalog import ensure_namespaces

    ensure_namespaces(spark, [db], location_root=location_root)
    spark.sql(f"DROP TABLE IF EXISTS `{db}`.`{name}`")
    spark.catalog.createTable(f"{db}.{name}", path=path, source="parquet")
    if name in MINUTE_MARTS:  # date-partitioned: register the partitions found
        spark.sql(f"ALTER TABLE `{db}`.`{name}` RECOVER PARTITIONS")


def update_table(spark: SparkSession, db: str, name: str, path: str, location_root: str | None = None) -> None:
    """Make ``db.name`` show what now lies at ``path``: new and removed dates, and
    replaced files. Registers the table if it is not there yet."""
    if not spark.catalog.databaseExists(db) or not spark.catalog.tableExists(f"{db}.{name}"):
        register_table(spark, db, name, path, location_root)
        return
    if name in MINUTE_MARTS:
        spark.sql(f"MSCK REPAIR TABLE `{db}`.`{name}` SYNC PARTITIONS")
    spark.catalog.refreshTable(f"{db}.{name}")
