"""Registered queries: one per operator family, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (trades are derived from
``events`` by ``sources.testdata``) over their whole extent; results
pass through ``boundary.stable``. Queries that exercise writers (lake,
refresh, snapshots, streams) first write to a fresh folder under the
session's checkpoint dir, then return a lazy read of what was written.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.functions.util import trade_order_key
from ticklake.operators import ingest, marts, quality, serving, staging, windows
from ticklake.plans import job_queries
from ticklake.plans.boundary import stable
from ticklake.plans.refresh import build_marts, read_mart
from ticklake.schema import NOT_NULL_RULES, STG_ORDER_COL
from ticklake.session import configure, scratch_path
from ticklake.sources.testdata import (
    events_stream,
    feed_messages,
    kafka_records,
    load_trades,
    trades_from_events,
    with_redelivery,
)

# Fixed as-of instant for health/serving reads on the test data (its
# trades span 2024-01-01 00:00 .. ~01:12 UTC, so some trades lie after it).
AS_OF = "2024-01-01 01:10:00"


def _stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return staging.stg_trades(load_trades(spark, sf_dir))


def q_stg_trades(spark, sf_dir):
    return stable(_stg(spark, sf_dir))


def q_fct_trades_1m(spark, sf_dir):
    return stable(marts.fct_trades_1m(_stg(spark, sf_dir)))


def q_fct_candles_1m(spark, sf_dir):
    return stable(marts.fct_candles_1m(_stg(spark, sf_dir)))


def q_fct_orderflow_1m(spark, sf_dir):
    return stable(marts.fct_orderflow_1m(_stg(spark, sf_dir)))


def q_fct_ingestion_latency_1m(spark, sf_dir):
    return stable(marts.fct_ingestion_latency_1m(_stg(spark, sf_dir)))


def q_fct_pipeline_health_5m(spark, sf_dir):
    return stable(marts.fct_pipeline_health_5m(_stg(spark, sf_dir), as_of=AS_OF))


# Serving parameters for the registered slice reads.
SLICE_PAIR = "CLICK"
SLICE_LOOKBACK = 30
TRADES_LOOKBACK = 1440


def q_open_close_row_number(spark, sf_dir):
    """earliest/latest trade per pair x minute (ROW_NUMBER() = 1)."""
    stg = _stg(spark, sf_dir).withColumn("minute_bucket", F.date_trunc("minute", "trade_ts_utc"))
    keys = ["pair", "minute_bucket"]
    return stable(windows.first_last(stg, keys, trade_order_key(STG_ORDER_COL, "trade_id"), "price", "open_price", "close_price"))


def q_candles_window_join_form(spark, sf_dir):
    """Aggregate part joined with the open/close part on (pair, minute)."""
    stg = _stg(spark, sf_dir).withColumn("minute_bucket", F.date_trunc("minute", "trade_ts_utc"))
    keys = ["pair", "minute_bucket"]
    agg = stg.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trade_count"),
        F.sum("qty").alias("total_qty"),
        F.sum(F.col("price") * F.col("qty")).alias("notional_usdt"),
        F.min("price").alias("low_price"),
        F.max("price").alias("high_price"),
    ).withColumn("vwap", F.col("notional_usdt") / F.when(F.col("total_qty") != 0, F.col("total_qty")))
    oc = windows.first_last(stg, keys, trade_order_key(STG_ORDER_COL, "trade_id"), "price", "open_price", "close_price")
    out = windows.join_on_keys(agg, oc, keys).select(
        "pair", "minute_bucket", "open_price", "high_price", "low_price", "close_price",
        "vwap", "trade_count", "total_qty", "notional_usdt",
    )
    return stable(out)


def q_latency_window_distinct_form(spark, sf_dir):
    """W3-W5 + A11: whole-group aggregates over a named window, then DISTINCT."""
    stg = _stg(spark, sf_dir).where(F.col("ingested_at_utc").isNotNull())
    calc = stg.select(
        "pair",
        F.date_trunc("minute", "trade_ts_utc").alias("minute_bucket"),
        F.timestamp_diff("SECOND", "trade_ts_utc", "ingested_at_utc").alias("latency_seconds"),
    )
    w = ["pair", "minute_bucket"]
    lat = F.col("latency_seconds")
    rows = windows.distinct_over_group(calc, w, [
        F.count(F.lit(1)).alias("trade_count"),
        F.avg(lat.cast("double")).alias("avg_latency_s"),
        F.min(lat).alias("min_latency_s"),
        F.max(lat).alias("max_latency_s"),
        F.percentile(lat, 0.95).alias("p95_latency_s"),
        F.percentile(lat, 0.99).alias("p99_latency_s"),
    ])
    return stable(rows)


def _marts(spark, sf_dir):
    return build_marts(_stg(spark, sf_dir), as_of=AS_OF)


def q_list_pairs(spark, sf_dir):
    return stable(serving.list_pairs(_marts(spark, sf_dir)["fct_candles_1m"]))


def q_candles_slice(spark, sf_dir):
    m = _marts(spark, sf_dir)["fct_candles_1m"]
    return stable(serving.candles_slice(m, SLICE_PAIR, SLICE_LOOKBACK, as_of=AS_OF))


def q_orderflow_slice(spark, sf_dir):
    m = _marts(spark, sf_dir)["fct_orderflow_1m"]
    return stable(serving.orderflow_slice(m, SLICE_PAIR, SLICE_LOOKBACK, as_of=AS_OF))


def q_trades_slice_top200(spark, sf_dir):
    m = _marts(spark, sf_dir)["fct_trades_1m"]
    return stable(serving.trades_slice(m, SLICE_PAIR, TRADES_LOOKBACK, as_of=AS_OF))


def _top5(mart_name, order="minute_bucket"):
    def q(spark, sf_dir):
        return stable(serving.top_n(_marts(spark, sf_dir)[mart_name], serving.REPORT_ROWS, order))
    q.__name__ = f"q_top5_{mart_name}"
    return q


def q_latest_candle_per_pair(spark, sf_dir):
    return stable(serving.latest_per_pair(_marts(spark, sf_dir)["fct_candles_1m"]))


def q_latest_candle_stats(spark, sf_dir):
    m = _marts(spark, sf_dir)["fct_candles_1m"]
    return stable(serving.latest_candle_stats(serving.candles_slice(m, SLICE_PAIR, SLICE_LOOKBACK, as_of=AS_OF)))


def q_quality_not_null(spark, sf_dir):
    """Q1/Q3: every not-null rule over staging and all five marts.

    The trades are aggregated once (minute table written to shared
    storage); the marts checked are projections of that table.
    """
    from ticklake.plans.refresh import ALL_MARTS, marts_from_stats, materialized_stats

    stg = _stg(spark, sf_dir)
    stats = materialized_stats(spark, stg, as_of=AS_OF)
    tables = {"stg_trades": stg, **marts_from_stats(stats, ALL_MARTS, AS_OF)}
    return stable(quality.run_checks(tables, NOT_NULL_RULES))


def _stg_redelivered(spark, sf_dir):
    configure(spark)
    return staging.stg_trades(with_redelivery(load_trades(spark, sf_dir)))


def q_quality_unique_trade_key(spark, sf_dir):
    return stable(quality.duplicate_keys(_stg_redelivered(spark, sf_dir), "trade_key"))


def q_dedupe_trades(spark, sf_dir):
    return stable(staging.dedupe_trades(_stg_redelivered(spark, sf_dir)))


# DLQ cap used by the registered DLQ query: small enough that most
# damaged payloads exercise the truncation path.
DLQ_TEST_MAX_BYTES = 120


def _checked(spark, sf_dir):
    configure(spark)
    return ingest.check_contract(kafka_records(load_trades(spark, sf_dir)), ingest.FULL)


def q_contract_check(spark, sf_dir):
    """Parse, key presence, JSON types -> error code or typed fields."""
    c = _checked(spark, sf_dir)
    return stable(c.select(
        "offset", "partition", "error", "schema_version", "event_id", "source", "ingested_at",
        "symbol", "trade_id", "trade_ts", "price", "qty", "is_buyer_maker",
    ))


def q_dlq_payload(spark, sf_dir):
    """Failing records -> DLQ key + JSON envelope (with truncation)."""
    return stable(ingest.to_dlq(ingest.bad_rows(_checked(spark, sf_dir)), max_bytes=DLQ_TEST_MAX_BYTES))


def q_ingest_counts(spark, sf_dir):
    """Consumed / landed / dead-lettered / next offset per partition."""
    return stable(ingest.ingest_counts(_checked(spark, sf_dir)))


def q_dlq_rate_10m(spark, sf_dir):
    """Q4: landed vs dead-lettered records per 10 minutes."""
    return stable(quality.dlq_rate_of(_checked(spark, sf_dir), "10 minutes"))


def q_normalize_feed(spark, sf_dir):
    """Raw exchange messages -> trade_v1 (uuid/now checked for shape)."""
    configure(spark)
    ev = ingest.normalize_feed(feed_messages(load_trades(spark, sf_dir)))
    return stable(ev.select(
        "schema_version", "source", "symbol", "trade_id", "trade_ts", "price", "qty",
        "is_buyer_maker",
        (F.length("event_id") == 36).alias("event_id_ok"),
        F.col("ingested_at").try_cast("timestamp").isNotNull().alias("ingested_ok"),
    ))


def q_partition_values(spark, sf_dir):
    """Epoch ms -> ('yyyy-MM-dd', 'HH') UTC partition names."""
    from ticklake.functions.time import partition_values

    t = load_trades(spark, sf_dir)
    d, h = partition_values("trade_ts")
    configure(spark)
    return stable(t.select("trade_id", d.alias("trade_date"), h.alias("hour")))


# Lake reads: a 15-minute range inside hour 00 of 2024-01-01.
RANGE_START = "2024-01-01 00:30:00"
RANGE_END = "2024-01-01 00:45:00"
# Snapshots: the first refresh sees trades before SNAP_1, the second all.
SNAP_1 = "2024-01-01 00:30:00"
SNAP_2 = "2024-01-01 01:30:00"
SNAP_READ = "2024-01-01 01:00:00"
# Time-ordered landing batches for the compaction query (minutes).
BATCH_EDGES_MIN = (24, 48)


def _written_lake(spark, sf_dir):
    from ticklake.sources.lake import write_lake

    configure(spark)
    root = scratch_path(spark, "lake")
    write_lake(load_trades(spark, sf_dir), root)
    return root


def _lake_cols(df):
    from ticklake.schema import LAKE_PARTITION_COLS, TRADE_V1_REQUIRED

    return df.select(*TRADE_V1_REQUIRED, *LAKE_PARTITION_COLS)


def q_lake_roundtrip(spark, sf_dir):
    """Partitioned zstd write, fixed-schema read of the whole lake."""
    from ticklake.sources.lake import read_lake

    root = _written_lake(spark, sf_dir)
    return stable(_lake_cols(read_lake(spark, root)))


def q_lake_range_read(spark, sf_dir):
    """Time-range read pruned to the matching date/hour partitions."""
    from ticklake.sources.lake import read_lake

    root = _written_lake(spark, sf_dir)
    return stable(_lake_cols(read_lake(spark, root, start=RANGE_START, end=RANGE_END)))


def q_external_table_scan(spark, sf_dir):
    """External table over the lake, partitions discovered."""
    from ticklake.sources.catalog import ensure_namespaces
    from ticklake.sources.lake import create_external_table

    root = _written_lake(spark, sf_dir)
    ensure_namespaces(spark, ["ext"], location_root=scratch_path(spark, "catalog"))
    name = create_external_table(spark, root, "ext", "trades")
    return stable(_lake_cols(spark.table(name)))


def q_lake_compaction(spark, sf_dir):
    """Three landing batches (many small files), compacted in place."""
    from ticklake.plans.compaction import compact
    from ticklake.sources.lake import read_lake, write_lake
    from ticklake.sources.testdata import BASE_MS

    configure(spark)
    root = scratch_path(spark, "lake")
    trades = load_trades(spark, sf_dir)
    edges = [None, *[BASE_MS + m * 60_000 for m in BATCH_EDGES_MIN], None]
    for lo, hi in zip(edges[:-1], edges[1:]):
        part = trades
        if lo is not None:
            part = part.where(F.col("trade_ts") >= lo)
        if hi is not None:
            part = part.where(F.col("trade_ts") < hi)
        write_lake(part, root)
    compact(spark, root)
    return stable(_lake_cols(read_lake(spark, root)))


def q_refresh_roundtrip(spark, sf_dir):
    """One-pass refresh of all marts to storage; candles read back."""
    from ticklake.plans.refresh import refresh

    stg = _stg(spark, sf_dir)
    root = scratch_path(spark, "marts")
    paths = refresh(spark, stg, root, as_of=AS_OF)
    return stable(read_mart(spark, paths["fct_candles_1m"]))


def q_refresh_incremental(spark, sf_dir):
    """Full refresh of the first 48 minutes, then the rest lands
    and only the touched date is rebuilt; the merged health report."""
    from ticklake.plans import jobs
    from ticklake.sources.lake import write_lake
    from ticklake.sources.testdata import BASE_MS

    configure(spark)
    lake, root = scratch_path(spark, "lake"), scratch_path(spark, "marts")
    trades = load_trades(spark, sf_dir)
    cut = BASE_MS + BATCH_EDGES_MIN[1] * 60_000
    write_lake(trades.where(F.col("trade_ts") < cut), lake)
    jobs.refresh_marts(spark, lake, root, as_of=AS_OF, db=None)
    write_lake(trades.where(F.col("trade_ts") >= cut), lake)
    paths = jobs.refresh_dates(spark, lake, root, ["2024-01-01"], as_of=AS_OF)
    return stable(read_mart(spark, paths["fct_pipeline_health_5m"]))


def q_asof_snapshot(spark, sf_dir):
    """Two snapshot refreshes; read the candles mart as of a past instant."""
    from ticklake.plans.snapshot import append_snapshot, read_as_of

    stg = _stg(spark, sf_dir)
    path = scratch_path(spark, "snapshots")
    early = stg.where(F.col("trade_ts_utc") < F.lit(SNAP_1).cast("timestamp"))
    append_snapshot(marts.fct_candles_1m(early), path, SNAP_1)
    append_snapshot(marts.fct_candles_1m(stg), path, SNAP_2)
    return stable(read_as_of(spark, path, SNAP_READ))


@contextmanager
def _state_partitions(spark):
    """A stateful query fixes its state partition count at first start (from
    ``spark.sql.shuffle.partitions``): the cluster's default parallelism here."""
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)


def _run_stream(df, name: str):
    """Drain a streaming DataFrame into a Parquet file sink; return its rows."""
    spark = df.sparkSession
    out = scratch_path(spark, name)
    with _state_partitions(spark):
        q = (
            df.writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", out + "-checkpoint")
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        q.awaitTermination()
    return spark.read.parquet(out)


# The test trades span 72 minutes; files may hold them in any order.
STREAM_DISORDER = "2 hours"


def q_stream_minute_marts(spark, sf_dir):
    """The streamed minute table, open minutes included; any number of input
    files in any order."""
    from ticklake.streaming.marts import read_minute_table, stream_minute_marts, write_minute_table

    configure(spark)
    stg = staging.stg_trades(trades_from_events(events_stream(spark, sf_dir, max_files_per_trigger=1)))
    root = scratch_path(spark, "stream-marts")
    with _state_partitions(spark):
        write_minute_table(stream_minute_marts(stg, STREAM_DISORDER), root, root + "-checkpoint", available_now=True).awaitTermination()
    return stable(read_minute_table(spark, root))


def q_stream_dedupe(spark, sf_dir):
    """Streaming dedupe of re-delivered trades within the watermark."""
    from ticklake.streaming.marts import dedupe_stream

    configure(spark)
    stg = staging.stg_trades(with_redelivery(trades_from_events(events_stream(spark, sf_dir))))
    out = _run_stream(dedupe_stream(stg, STREAM_DISORDER), "stream-dedupe")
    return stable(out.select("pair", "trade_id", "trade_ts_utc", "price", "qty", "is_buyer_maker", "trade_key"))


def q_rolling_activity_5m(spark, sf_dir):
    """T4: trades per pair in 5-minute windows sliding by 1 minute."""
    from ticklake.streaming.marts import rolling_activity

    return stable(rolling_activity(_stg(spark, sf_dir)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stg_trades": q_stg_trades,
    "fct_trades_1m": q_fct_trades_1m,
    "fct_candles_1m": q_fct_candles_1m,
    "fct_orderflow_1m": q_fct_orderflow_1m,
    "fct_ingestion_latency_1m": q_fct_ingestion_latency_1m,
    "fct_pipeline_health_5m": q_fct_pipeline_health_5m,
    "open_close_row_number": q_open_close_row_number,
    "candles_window_join_form": q_candles_window_join_form,
    "latency_window_distinct_form": q_latency_window_distinct_form,
    "list_pairs": q_list_pairs,
    "candles_slice": q_candles_slice,
    "orderflow_slice": q_orderflow_slice,
    "trades_slice_top200": q_trades_slice_top200,
    "latest_candles_top5": _top5("fct_candles_1m"),
    "latest_orderflow_top5": _top5("fct_orderflow_1m"),
    "latest_trades_top5": _top5("fct_trades_1m"),
    "latest_latency_top5": _top5("fct_ingestion_latency_1m"),
    "health_top5": _top5("fct_pipeline_health_5m", None),
    "latest_candle_per_pair": q_latest_candle_per_pair,
    "latest_candle_stats": q_latest_candle_stats,
    "quality_not_null": q_quality_not_null,
    "quality_unique_trade_key": q_quality_unique_trade_key,
    "dedupe_trades": q_dedupe_trades,
    "contract_check": q_contract_check,
    "dlq_payload": q_dlq_payload,
    "ingest_counts": q_ingest_counts,
    "dlq_rate_10m": q_dlq_rate_10m,
    "normalize_feed": q_normalize_feed,
    "partition_values": q_partition_values,
    "lake_roundtrip": q_lake_roundtrip,
    "lake_range_read": q_lake_range_read,
    "external_table_scan": q_external_table_scan,
    "lake_compaction": q_lake_compaction,
    "refresh_roundtrip": q_refresh_roundtrip,
    "refresh_incremental": q_refresh_incremental,
    "asof_snapshot": q_asof_snapshot,
    "stream_minute_marts": q_stream_minute_marts,
    "stream_dedupe": q_stream_dedupe,
    "rolling_activity_5m": q_rolling_activity_5m,
}


QUERIES |= job_queries.QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
