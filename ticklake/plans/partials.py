"""Refresh from mergeable partials: a batch reads its own trades only.

``root/minutes`` holds the measures of each batch per (pair, minute, second of
latency), ``root/seconds`` its trades per (pair, second), both under
``trade_date=/batch=``. A batch adds its partials (replacing its own, so a replay
changes nothing), then the marts of the dates that it touched are merged from all
partials of those dates, and the health report from the recent seconds and the
previous report. No trade is read twice, late or not.

A date's batches are folded into one set of files when there are over
``FOLD_BATCHES``, by a swap that a crash cannot break, so folders and rows stay
bounded by minutes, not by batches.

Partials add up deliveries; a lake whose trades arrive more than once and are to
count once needs ``jobs.refresh_dates(dedupe=True)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.operators import marts as M
from ticklake.operators.staging import stg_trades
from ticklake.plans import refresh as R
from ticklake.session import configure, scratch_path
from ticklake.sources import files

FOLD_BATCHES = 24
_DAY = "trade_date"


def _second_counts(stg: DataFrame) -> DataFrame:
    """Trades per (pair, second), with the newest ingest: what the health report
    counts from. Trade times are whole seconds."""
    return stg.groupBy("pair", "trade_ts_utc").agg(F.count(F.lit(1)).alias("n"), F.max("ingested_at_utc").alias("max_ingested"))


def _fold_seconds(rows: DataFrame) -> DataFrame:
    return rows.groupBy("pair", "trade_ts_utc").agg(F.sum("n").alias("n"), F.max("max_ingested").alias("max_ingested"))


TABLES = {
    "minutes": (M.latency_counts, M.fold_counts, "minute_bucket"),
    "seconds": (_second_counts, _fold_seconds, "trade_ts_utc"),
}


def add_partials(trades: DataFrame, root: str, batch: int) -> list[str]:
    """Write the partials of one batch of trade_v1 rows; returns its dates."""
    spark = trades.sparkSession
    stg = stg_trades(trades).persist()  # both tables in one read of the batch
    try:
        for name, (count, _, at) in TABLES.items():
            rows = count(stg).withColumn(_DAY, F.to_date(at)).withColumn("batch", F.lit(batch).cast("long"))
            (
                rows.hint("rebalance", _DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy(_DAY, "batch").parquet(f"{root.rstrip('/')}/{name}")
            )
        return [str(r[0]) for r in stg.select(F.to_date("trade_ts_utc")).distinct().collect()]
    finally:
        stg.unpersist()


def _partials(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}")


def _on(dates: list[str]):
    return F.col(_DAY).isin(*[F.lit(d).cast("date") for d in dates])


def fold(spark: SparkSession, root: str, dates: list[str], before: int, most: int = FOLD_BATCHES) -> int:
    """Merge the partials that batches before ``before`` left on each of ``dates`` that
    has over ``most`` of them; returns the dates folded. Single writer."""
    done = 0
    for name, (_, merge, _) in TABLES.items():
        base = f"{root.rstrip('/')}/{name}"
        found = files.file_rows(spark, base).select(
            "path", F.regexp_extract("path", f"/{_DAY}=([^/]+)/", 1).alias("day"),
            F.regexp_extract("path", "/batch=([0-9]+)/", 1).cast("long").alias("batch"),
        )
        by_day: dict[str, list] = {}
        for r in found.where((F.col("batch") < before) & F.col("day").isin(dates)).collect():  # file names
            by_day.setdefault(r.day, []).append(r)
        for day, old in by_day.items():
            batches = {r.batch for r in old}
            if len(batches) <= most:
                continue
            rows = merge(spark.read.parquet(*[r.path for r in old]))
            done += files.replace(spark, base, [r.path for r in old], rows, f"{base}/{_DAY}={day}/batch={max(batches)}")
    return done


def refresh_merged(trades: DataFrame, partials_root: str, marts_root: str, batch: int, as_of=None,
                   lookback: str = M.HEALTH_LOOKBACK, db: str | None = None) -> dict[str, str]:
    """All five marts after ``trades``, one batch of trade_v1 rows.

    Equal to a full rebuild over the trades of all batches. ``batch`` must be
    the same when a batch is given again, and rise otherwise.
    """
    from ticklake.plans.jobs import _interval, _read_if_exists

    spark = trades.sparkSession
    configure(spark)
    if as_of is None:
        as_of = spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    for name in TABLES:
        files.recover(spark, f"{partials_root.rstrip('/')}/{name}")
    dates = add_partials(trades, partials_root, batch)
    paths: dict[str, str] = {}
    if dates:
        stats_at = scratch_path(spark, "minute-stats")
        M.merge_counts(_partials(spark, partials_root, "minutes").where(_on(dates))).write.parquet(stats_at)
        stats = spark.read.parquet(stats_at)
        paths = R.write_marts(R.marts_from_stats(stats, list(R.MINUTE_MARTS), as_of), marts_root, dates_only=True)
    if dates or _read_if_exists(spark, f"{partials_root.rstrip('/')}/seconds") is not None:
        paths[R.HEALTH_MART] = _merge_health(spark, partials_root, marts_root, batch, as_of, lookback, _interval(lookback))
    if db:
        for name, path in paths.items():
            R.update_table(spark, db, name, path, location_root=f"{marts_root.rstrip('/')}/_catalog")
    fold(spark, partials_root, dates, batch)
    return paths


def _merge_health(spark, partials_root, marts_root, batch, as_of, lookback, span) -> str:
    """Recent seconds, this batch's newest times and the previous report."""
    import datetime as dt

    from ticklake.plans.jobs import _read_if_exists

    path = f"{marts_root.rstrip('/')}/{R.HEALTH_MART}"
    seconds = _partials(spark, partials_root, "seconds")
    threshold = M.as_of_col(as_of) - F.expr(f"INTERVAL {lookback}")
    first_day = (dt.datetime.fromisoformat(str(as_of)) - span).date()
    recent = seconds.where((F.col(_DAY) >= F.lit(first_day)) & (F.col("trade_ts_utc") >= threshold))
    own = seconds.where(F.col("batch") == batch)
    one = lambda rows, n: rows.select(
        "pair", n.alias("n"), F.col("trade_ts_utc").alias("mt"), F.col("max_ingested").alias("mi"))
    parts = one(recent, F.col("n")).unionByName(one(own, F.lit(0).cast("bigint")))
    if (prev := _read_if_exists(spark, path)) is not None:
        parts = parts.unionByName(prev.select(
            "pair", F.lit(0).cast("bigint").alias("n"), F.col("max_trade_ts_utc").alias("mt"), F.col("max_ingested_at_utc").alias("mi")))
    per_pair = parts.groupBy("pair").agg(
        F.sum("n").alias("trades_last_5m"), F.max("mt").alias("max_trade_ts_utc"), F.max("mi").alias("max_ingested_at_utc"))
    staged = scratch_path(spark, "health")
    M._health_project(per_pair, as_of).write.parquet(staged)
    R.materialize(spark.read.parquet(staged), path, R.HEALTH_MART)
    return path
