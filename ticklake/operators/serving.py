"""Serving reads over the marts: pair list, time slices, top-k, latest rows.

Parameters are typed (no SQL text is assembled from user input). Slice
predicates are on the mart's grouping columns, so Catalyst pushes them
below the aggregate — or, on a stored mart, into the Parquet scan.
Top-k reads plan as ``TakeOrderedAndProject`` (per-partition top-k,
then a bounded merge); the k is the feature, not a cap on work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.functions.time import lookback_start
from ticklake.operators.marts import as_of_col
from ticklake.schema import MART_COLUMNS

# Lookback choices offered by the dashboard (minutes) and
# its default, the pair shown when no mart has rows, and slice sizes.
LOOKBACK_CHOICES = (30, 60, 180, 360, 720, 1440)
DEFAULT_LOOKBACK = 180
FALLBACK_PAIR = "BTCUSDT"
TRADES_SLICE_ROWS = 200
REPORT_ROWS = 5
# Directory key of the stored minute marts; no column of their contract.
STORAGE_DATE = "trade_date"


def slice_start(as_of=None, lookback_minutes: int = DEFAULT_LOOKBACK) -> Column:
    """Lower bound of a slice, truncated to whole seconds like the dashboard."""
    return F.date_trunc("second", lookback_start(as_of_col(as_of), lookback_minutes))


def time_slice(mart: DataFrame, pair: str, lookback_minutes: int = DEFAULT_LOOKBACK,
               as_of=None, ts_col: str = "minute_bucket") -> DataFrame:
    """``pair = p AND minute_bucket >= as_of - lookback`` (no upper bound).

    On a stored mart (with its ``trade_date`` directories) the same bound is
    put on the date, so that older directories are not listed or read; the
    storage column is not part of the result.
    """
    start = slice_start(as_of, lookback_minutes)
    out = mart.where((F.col("pair") == F.lit(pair)) & (F.col(ts_col) >= start))
    if STORAGE_DATE in mart.columns:
        out = out.where(F.col(STORAGE_DATE) >= F.to_date(start)).drop(STORAGE_DATE)
    return out


def list_pairs(candles: DataFrame) -> DataFrame:
    """Distinct pairs in order; a single fallback pair when the mart is empty.

    Emptiness is an uncorrelated scalar subquery over ``limit(1)`` of the
    pairs (evaluated once, inlined as a literal) — no join, no collect.
    """
    pairs = candles.select("pair").distinct()
    any_rows = pairs.limit(1).agg(F.count(F.lit(1))).scalar()
    fallback = candles.sparkSession.range(1).select(F.lit(FALLBACK_PAIR).alias("pair")).where(any_rows == 0)
    return pairs.unionByName(fallback).orderBy("pair")


def candles_slice(candles: DataFrame, pair: str, lookback_minutes: int = DEFAULT_LOOKBACK,
                  as_of=None) -> DataFrame:
    return time_slice(candles, pair, lookback_minutes, as_of).orderBy("minute_bucket")


def orderflow_slice(orderflow: DataFrame, pair: str, lookback_minutes: int = DEFAULT_LOOKBACK,
                    as_of=None, series_only: bool = True) -> DataFrame:
    """Order-flow slice; by default only the two plotted series."""
    s = time_slice(orderflow, pair, lookback_minutes, as_of)
    if series_only:
        s = s.select("pair", "minute_bucket", "qty_imbalance", "buy_qty_ratio")
    return s.orderBy("minute_bucket")


def trades_slice(trades: DataFrame, pair: str, lookback_minutes: int = DEFAULT_LOOKBACK,
                 as_of=None, n: int = TRADES_SLICE_ROWS) -> DataFrame:
    """Newest ``n`` minutes of a pair within the lookback."""
    return time_slice(trades, pair, lookback_minutes, as_of).orderBy(
        F.col("minute_bucket").desc()
    ).limit(n)


def top_n(mart: DataFrame, n: int = REPORT_ROWS, order_col: str | None = "minute_bucket") -> DataFrame:
    """Newest ``n`` rows by ``order_col`` (pair breaks ties); pair order if none."""
    if order_col is None:
        return mart.orderBy("pair").limit(n)
    return mart.orderBy(F.col(order_col).desc(), F.col("pair").asc()).limit(n)


def latest_per_pair(mart: DataFrame, ts_col: str = "minute_bucket") -> DataFrame:
    """Newest row of every pair, as an aggregate (``max_by`` of the row)."""
    cols = [c for c in mart.columns if c != "pair"]
    return mart.groupBy("pair").agg(
        F.max_by(F.struct(*cols), F.col(ts_col)).alias("_r")
    ).select("pair", *[F.col(f"_r.{c}").alias(c) for c in cols])


def latest_candle_stats(candles_slice_df: DataFrame) -> DataFrame:
    """Last candle of a slice -> trade count, qty, notional, VWAP."""
    return candles_slice_df.orderBy(F.col("minute_bucket").desc()).limit(1).select(
        "pair", "minute_bucket", "trade_count", "total_qty", "notional_usdt", "vwap"
    )


# -- catalog-backed reads ----------------------------------------------------

REQUIRED_MARTS = ("fct_candles_1m", "fct_orderflow_1m", "fct_trades_1m")
REPORT = (
    ("Newest candle minutes", "fct_candles_1m", "minute_bucket"),
    ("Newest order-flow minutes", "fct_orderflow_1m", "minute_bucket"),
    ("Newest trade minutes", "fct_trades_1m", "minute_bucket"),
    ("Pipeline health by pair", "fct_pipeline_health_5m", None),
    ("Newest ingest-latency minutes", "fct_ingestion_latency_1m", "minute_bucket"),
)


class MissingMartsError(RuntimeError):
    pass


def mart_table(spark: SparkSession, name: str, db: str = "marts") -> DataFrame:
    """A registered mart with the columns of its contract."""
    return spark.table(f"{db}.{name}").select(*MART_COLUMNS[name])


def missing_marts(spark: SparkSession, db: str = "marts", required=REQUIRED_MARTS) -> list[str]:
    """Required marts that do not exist in ``db``."""
    return [t for t in required if not spark.catalog.tableExists(f"{db}.{t}")]


def require_marts(spark: SparkSession, db: str = "marts", required=REQUIRED_MARTS) -> None:
    missing = missing_marts(spark, db, required)
    if missing:
        raise MissingMartsError(f"{db} lacks {', '.join(missing)}: build them with jobs.refresh_marts")


def health_table(spark: SparkSession, db: str = "marts") -> DataFrame | None:
    """All pairs of the health mart, ordered; None when the table is absent."""
    if not spark.catalog.tableExists(f"{db}.fct_pipeline_health_5m"):
        return None
    return mart_table(spark, "fct_pipeline_health_5m", db).orderBy("pair")


def latest_of_each_mart(spark: SparkSession, db: str = "marts", n: int = REPORT_ROWS) -> dict[str, DataFrame]:
    """Titled top-``n`` reads of every mart (the CLI report)."""
    return {
        title: top_n(mart_table(spark, table, db), n, order)
        for title, table, order in REPORT
        if spark.catalog.tableExists(f"{db}.{table}")
    }


def dashboard(spark: SparkSession, db: str = "marts", pair: str | None = None,
              lookback_minutes: int = DEFAULT_LOOKBACK, as_of=None) -> dict[str, DataFrame | None]:
    """Every dashboard panel as a DataFrame (nothing is collected except
    the default pair: the first row of the ordered pair list).

    Raises ``MissingMartsError`` when a required mart is absent; the
    health panel is ``None`` when its mart is absent (it is optional).
    """
    require_marts(spark, db)
    candles = spark.table(f"{db}.fct_candles_1m")  # slices prune by its storage date
    pairs = list_pairs(candles)
    if pair is None:
        pair = pairs.first()["pair"]
    c = candles_slice(candles, pair, lookback_minutes, as_of)
    return {
        "pairs": pairs,
        "health": health_table(spark, db),
        "candles": c,
        "latest": latest_candle_stats(c),
        "orderflow": orderflow_slice(spark.table(f"{db}.fct_orderflow_1m"), pair, lookback_minutes, as_of),
        "trades": trades_slice(spark.table(f"{db}.fct_trades_1m"), pair, lookback_minutes, as_of),
    }
