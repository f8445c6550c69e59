"""Minute-grain marts and the pipeline-health report.

Every minute mart is ONE ``groupBy(pair, minute_bucket)`` over staging:
partial aggregates are combined map-side before the shuffle, so a hot
pair (or a hot minute) never sends its raw rows to one task. Open and
close prices use ``min_by``/``max_by`` on a single decimal ordering key
(hash-aggregable), replacing the reference-shaped "two row_number
windows + self-join". Both percentiles come from one exact
``percentile`` buffer per group over pre-counted latencies.

``minute_stats`` can compute all four minute marts in a single pass;
``plans.refresh`` uses that so a full refresh shuffles the trades once.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.functions.time import bucket_start, minute_bucket, seconds_between
from ticklake.functions.util import nullif_zero, safe_ratio, sum_if, trade_order_key
from ticklake.schema import (
    FCT_CANDLES_1M,
    FCT_INGESTION_LATENCY_1M,
    FCT_ORDERFLOW_1M,
    FCT_PIPELINE_HEALTH_5M,
    FCT_TRADES_1M,
    STG_ORDER_COL,
)

# Measure groups understood by ``minute_stats``.
TRADES = "trades"
CANDLES = "candles"
ORDERFLOW = "orderflow"
LATENCY = "latency"
HEALTH = "health"
ALL_MINUTE = (TRADES, CANDLES, ORDERFLOW, LATENCY)

HEALTH_LOOKBACK = "5 minutes"


def as_of_col(as_of) -> Column:
    """``None`` -> ``current_timestamp()`` (fixed per query); str/datetime -> literal."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.datetime):
        return F.lit(as_of).cast("timestamp")
    return F.lit(str(as_of)).cast("timestamp")


def _latency() -> Column:
    return seconds_between("trade_ts_utc", "ingested_at_utc")


def _measures(groups, as_of=None, lookback: str = HEALTH_LOOKBACK) -> list[Column]:
    g = set(groups)
    price, qty = F.col("price"), F.col("qty")
    notional = price * qty
    out: list[Column] = []
    if g & {TRADES, CANDLES, ORDERFLOW}:
        out += [
            F.count(F.lit(1)).alias("trade_count"),
            F.sum(qty).alias("total_qty"),
            F.sum(notional).alias("notional_usdt"),
        ]
    if g & {TRADES, CANDLES}:
        out += [F.min(price).alias("min_price"), F.max(price).alias("max_price")]
    if TRADES in g:
        out += [F.avg(price).alias("avg_price")]
    if CANDLES in g:
        key = trade_order_key(STG_ORDER_COL, "trade_id")
        out += [
            F.min_by(price, key).alias("open_price"),
            F.max_by(price, key).alias("close_price"),
        ]
    if ORDERFLOW in g:
        flag = F.col("is_buyer_maker")
        out += [
            sum_if(flag == 0, qty).alias("buy_qty"),
            sum_if(flag == 1, qty).alias("sell_qty"),
            sum_if(flag == 0, notional).alias("buy_notional_usdt"),
            sum_if(flag == 1, notional).alias("sell_notional_usdt"),
        ]
    if LATENCY in g:
        lat = _latency()
        out += [
            F.count(lat).alias("latency_count"),
            F.avg(lat.cast("double")).alias("avg_latency_s"),
            F.min(lat).alias("min_latency_s"),
            F.max(lat).alias("max_latency_s"),
            F.percentile(lat, [0.95, 0.99]).alias("_latency_pct"),
        ]
    if HEALTH in g:
        since = as_of_col(as_of) - F.expr(f"INTERVAL {lookback}")
        out += [
            F.count_if(F.col("trade_ts_utc") >= since).alias("trades_recent"),
            F.max("trade_ts_utc").alias("max_trade_ts_utc"),
            F.max("ingested_at_utc").alias("max_ingested_at_utc"),
        ]
    return out


def minute_stats(
    stg: DataFrame,
    groups=ALL_MINUTE,
    as_of=None,
    bucket: Column | str | None = None,
    lookback: str = HEALTH_LOOKBACK,
) -> DataFrame:
    """One row per (pair, minute_bucket) with the measures of ``groups``.

    ``bucket``: ``None``/``"1 minute"`` truncates to the minute; another
    width (``"5 minutes"``) uses epoch-aligned tumbling buckets; a
    ``window(...)`` Column groups by the event-time window struct itself
    (streaming: lets the watermark close buckets). The output column is
    ``minute_bucket`` (bucket start) either way.
    """
    base = stg.where(F.col("trade_ts_utc").isNotNull())
    if LATENCY in groups and not isinstance(bucket, Column) and not stg.isStreaming:
        return _by_latency_first(base, groups, as_of, bucket or "1 minute", lookback)
    if isinstance(bucket, str) and bucket.strip().lower() not in ("1 minute", "minute"):
        bucket = F.window("trade_ts_utc", bucket)
    if bucket is None or isinstance(bucket, str):
        return base.groupBy(
            F.col("pair"), minute_bucket("trade_ts_utc").alias("minute_bucket")
        ).agg(*_measures(groups, as_of, lookback))
    # Event-time window: group by the window struct itself so a watermark
    # can finalise and evict buckets, then expose its start.
    out = base.groupBy(F.col("pair"), bucket.alias("_bucket")).agg(*_measures(groups, as_of, lookback))
    rest = [c for c in out.columns if c not in ("pair", "_bucket")]
    return out.select("pair", F.col("_bucket.start").alias("minute_bucket"), *rest)


def _by_latency_first(base: DataFrame, groups, as_of, bucket: str, lookback: str) -> DataFrame:
    """``minute_stats`` with percentiles, in two levels.

    A percentile next to the other measures would put every trade through an
    object aggregate, which falls back to sorting. So trades are first
    counted per (pair, minute, whole second of latency) with all measures in
    a hash aggregate; the second level merges these few rows per minute and
    takes the exact percentile of the counted latencies.
    """
    return merge_counts(latency_counts(base, groups, as_of, bucket, lookback))


def latency_counts(stg: DataFrame, groups=ALL_MINUTE, as_of=None, bucket: Column | str = "1 minute",
                   lookback: str = HEALTH_LOOKBACK) -> DataFrame:
    """Mergeable partials: the measures of ``groups`` per (pair, minute, whole second
    of latency). Rows of the same key from any number of passes add up. A
    ``window(...)`` Column as ``bucket`` is grouped by as it is (streaming)."""
    rest = tuple(g for g in groups if g != LATENCY)
    at = bucket if isinstance(bucket, Column) else bucket_start("trade_ts_utc", bucket)
    keys = [F.col("pair"), at.alias("minute_bucket"), _latency().alias("_lat")]
    order = trade_order_key(STG_ORDER_COL, "trade_id")
    first = [
        *_measures(rest, as_of, lookback), F.count(F.lit(1)).alias("_n"),
        F.min(order).alias("_first"), F.max(order).alias("_last"),
    ]
    if TRADES in rest:  # an average does not add up; its sum and count do
        first += [F.sum("price").alias("_price_sum"), F.count("price").alias("_price_n")]
    counted = stg.groupBy(*keys).agg(*first).drop("avg_price")
    return counted.withColumn("minute_bucket", F.col("minute_bucket.start")) if isinstance(bucket, Column) else counted


_MERGE = {
    "trade_count": F.sum, "total_qty": F.sum, "notional_usdt": F.sum, "min_price": F.min, "max_price": F.max,
    "buy_qty": F.sum, "sell_qty": F.sum, "buy_notional_usdt": F.sum, "sell_notional_usdt": F.sum,
    "trades_recent": F.sum, "max_trade_ts_utc": F.max, "max_ingested_at_utc": F.max,
}


def _merged(counted: DataFrame) -> list[Column]:
    out = [f(c).alias(c) for c, f in _MERGE.items() if c in counted.columns]
    if "open_price" in counted.columns:
        out += [F.min_by("open_price", "_first").alias("open_price"), F.max_by("close_price", "_last").alias("close_price")]
    return out


def fold_counts(counted: DataFrame) -> DataFrame:
    """Partials of the same key merged into one row; the same columns."""
    again = {"_n": F.sum, "_price_sum": F.sum, "_price_n": F.sum, "_first": F.min, "_last": F.max}
    return counted.groupBy("pair", "minute_bucket", "_lat").agg(
        *_merged(counted), *(f(c).alias(c) for c, f in again.items() if c in counted.columns)
    )


def merge_counts(counted: DataFrame) -> DataFrame:
    """``latency_counts`` rows -> one row per (pair, minute_bucket), with the exact
    percentiles of the counted latencies."""
    lat, n = F.col("_lat"), F.when(F.col("_lat").isNotNull(), F.col("_n")).otherwise(0)
    out = _merged(counted)
    if "_price_sum" in counted.columns:
        out.append((F.sum("_price_sum") / nullif_zero(F.sum("_price_n"))).alias("avg_price"))
    out += [
        F.sum(n).alias("latency_count"),
        (F.sum(lat * n).cast("double") / nullif_zero(F.sum(n))).alias("avg_latency_s"),
        F.min(lat).alias("min_latency_s"),
        F.max(lat).alias("max_latency_s"),
        F.percentile(lat, [0.95, 0.99], n).alias("_latency_pct"),
    ]
    return counted.groupBy("pair", "minute_bucket").agg(*out)


# -- projections from minute stats ------------------------------------------


def trades_from_stats(stats: DataFrame) -> DataFrame:
    return stats.select(*FCT_TRADES_1M)


def candles_from_stats(stats: DataFrame) -> DataFrame:
    return stats.select(
        "pair",
        "minute_bucket",
        "open_price",
        F.col("max_price").alias("high_price"),
        F.col("min_price").alias("low_price"),
        "close_price",
        safe_ratio("notional_usdt", "total_qty").alias("vwap"),
        "trade_count",
        "total_qty",
        "notional_usdt",
    ).select(*FCT_CANDLES_1M)


def orderflow_from_stats(stats: DataFrame) -> DataFrame:
    return stats.select(
        "pair",
        "minute_bucket",
        "trade_count",
        "total_qty",
        "notional_usdt",
        "buy_qty",
        "sell_qty",
        "buy_notional_usdt",
        "sell_notional_usdt",
        (F.col("buy_qty") - F.col("sell_qty")).alias("qty_imbalance"),
        (F.col("buy_notional_usdt") - F.col("sell_notional_usdt")).alias("notional_imbalance"),
        safe_ratio("buy_qty", "total_qty").alias("buy_qty_ratio"),
        safe_ratio("sell_qty", "total_qty").alias("sell_qty_ratio"),
        safe_ratio("buy_notional_usdt", "notional_usdt").alias("buy_notional_ratio"),
        safe_ratio("sell_notional_usdt", "notional_usdt").alias("sell_notional_ratio"),
    ).select(*FCT_ORDERFLOW_1M)


def latency_from_stats(stats: DataFrame) -> DataFrame:
    """Buckets with no timed ingest are absent (as in the reference)."""
    return stats.where(F.col("latency_count") > 0).select(
        "pair",
        "minute_bucket",
        F.col("latency_count").alias("trade_count"),
        "avg_latency_s",
        "min_latency_s",
        "max_latency_s",
        F.col("_latency_pct")[0].alias("p95_latency_s"),
        F.col("_latency_pct")[1].alias("p99_latency_s"),
    ).select(*FCT_INGESTION_LATENCY_1M)


def health_from_stats(stats: DataFrame, as_of=None) -> DataFrame:
    """Roll per-minute health partials up to one row per pair.

    ``stats`` must carry the HEALTH measures computed with the same
    ``as_of``; the roll-up reads the small minute table, not the trades.
    """
    per_pair = stats.groupBy("pair").agg(
        F.sum("trades_recent").alias("trades_last_5m"),
        F.max("max_trade_ts_utc").alias("max_trade_ts_utc"),
        F.max("max_ingested_at_utc").alias("max_ingested_at_utc"),
    )
    return _health_project(per_pair, as_of)


def _health_project(per_pair: DataFrame, as_of) -> DataFrame:
    now = as_of_col(as_of)
    return per_pair.select(
        "pair",
        F.coalesce(F.col("trades_last_5m"), F.lit(0)).cast("bigint").alias("trades_last_5m"),
        "max_trade_ts_utc",
        "max_ingested_at_utc",
        seconds_between("max_trade_ts_utc", now).alias("seconds_since_last_trade"),
        seconds_between("max_ingested_at_utc", now).alias("seconds_since_last_ingest"),
    ).select(*FCT_PIPELINE_HEALTH_5M)


# Wide minute table: every minute mart's columns in one row per bucket.
WIDE_MINUTE_COLUMNS = (
    *FCT_CANDLES_1M,
    "avg_price",
    *[c for c in FCT_ORDERFLOW_1M if c not in FCT_CANDLES_1M],
    "latency_count",
    *[c for c in FCT_INGESTION_LATENCY_1M if c not in FCT_CANDLES_1M],
)


def wide_from_stats(stats: DataFrame) -> DataFrame:
    """All minute-mart columns from one aggregate, in a single projection
    (streams cannot join two projections of the same aggregate)."""
    exprs = {
        "high_price": F.col("max_price"),
        "low_price": F.col("min_price"),
        "vwap": safe_ratio("notional_usdt", "total_qty"),
        "qty_imbalance": F.col("buy_qty") - F.col("sell_qty"),
        "notional_imbalance": F.col("buy_notional_usdt") - F.col("sell_notional_usdt"),
        "buy_qty_ratio": safe_ratio("buy_qty", "total_qty"),
        "sell_qty_ratio": safe_ratio("sell_qty", "total_qty"),
        "buy_notional_ratio": safe_ratio("buy_notional_usdt", "notional_usdt"),
        "sell_notional_ratio": safe_ratio("sell_notional_usdt", "notional_usdt"),
        "p95_latency_s": F.col("_latency_pct")[0],
        "p99_latency_s": F.col("_latency_pct")[1],
    }
    return stats.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in WIDE_MINUTE_COLUMNS])


def marts_from_wide(wide: DataFrame) -> dict[str, DataFrame]:
    """Split a wide minute table (e.g. the streaming sink) into the four
    minute marts — projections only, no aggregation."""
    return {
        "fct_trades_1m": wide.select(*[
            F.col({"min_price": "low_price", "max_price": "high_price"}.get(c, c)).alias(c) for c in FCT_TRADES_1M
        ]),
        "fct_candles_1m": wide.select(*FCT_CANDLES_1M),
        "fct_orderflow_1m": wide.select(*FCT_ORDERFLOW_1M),
        "fct_ingestion_latency_1m": wide.where(F.col("latency_count") > 0).select(
            *[F.col("latency_count").alias(c) if c == "trade_count" else F.col(c) for c in FCT_INGESTION_LATENCY_1M]
        ),
    }


# -- the five marts ---------------------------------------------------------


def fct_trades_1m(stg: DataFrame, bucket: str = "1 minute") -> DataFrame:
    """Per pair x minute: count, qty, notional, avg/min/max price."""
    return trades_from_stats(minute_stats(stg, (TRADES,), bucket=bucket))


def fct_candles_1m(stg: DataFrame, bucket: str = "1 minute") -> DataFrame:
    """Per pair x minute: OHLC (open/close by trade ms, then trade_id), VWAP."""
    return candles_from_stats(minute_stats(stg, (CANDLES,), bucket=bucket))


def fct_orderflow_1m(stg: DataFrame, bucket: str = "1 minute") -> DataFrame:
    """Per pair x minute: buy (maker flag 0) vs sell (flag 1) split and ratios."""
    return orderflow_from_stats(minute_stats(stg, (ORDERFLOW,), bucket=bucket))


def fct_ingestion_latency_1m(stg: DataFrame, exact: bool = True, bucket: str = "1 minute") -> DataFrame:
    """Per pair x minute: count, avg/min/max and p95/p99 of ingest latency (s).

    ``exact=False`` swaps the exact percentile for ``percentile_approx``
    (fixed-size sketch) for coarse buckets with very many distinct values.
    """
    timed = stg.where(F.col("trade_ts_utc").isNotNull() & F.col("ingested_at_utc").isNotNull())
    stats = minute_stats(timed, (LATENCY,), bucket=bucket)
    if not exact:
        lat = _latency()
        stats = timed.groupBy("pair", bucket_start("trade_ts_utc", bucket).alias("minute_bucket")).agg(
            F.count(lat).alias("latency_count"),
            F.avg(lat.cast("double")).alias("avg_latency_s"),
            F.min(lat).alias("min_latency_s"),
            F.max(lat).alias("max_latency_s"),
            F.percentile_approx(lat.cast("double"), [0.95, 0.99], 10000).alias("_latency_pct"),
        )
    return latency_from_stats(stats)


def fct_pipeline_health_5m(stg: DataFrame, as_of=None, lookback: str = HEALTH_LOOKBACK) -> DataFrame:
    """Per pair: trades in the ``lookback`` (5 minutes) before ``as_of`` (no
    upper bound: future-stamped trades count), newest trade / ingest time
    and staleness in whole seconds. ``as_of`` defaults to the query's
    current time."""
    per_pair = stg.where(F.col("trade_ts_utc").isNotNull()).groupBy("pair").agg(
        *_measures((HEALTH,), as_of, lookback)
    ).withColumnRenamed("trades_recent", "trades_last_5m")
    return _health_project(per_pair, as_of)


MART_BUILDERS = {
    "fct_trades_1m": fct_trades_1m,
    "fct_candles_1m": fct_candles_1m,
    "fct_orderflow_1m": fct_orderflow_1m,
    "fct_ingestion_latency_1m": fct_ingestion_latency_1m,
    "fct_pipeline_health_5m": fct_pipeline_health_5m,
}
