"""Fixed schemas of every record and table (no inference anywhere).

Unknown JSON keys are dropped at the contract step; column order of
the staging view and the marts is part of the contract.
"""

from __future__ import annotations

from pyspark.sql import types as T

# -- raw exchange message (feed) -------------------------------------------
# Keys ``e``/``E`` and ``t``/``T`` differ only by case, so the message is
# read as VARIANT and extracted with case-exact paths, never as a struct.
FEED_FIELDS = ("e", "E", "s", "t", "p", "q", "T", "m")

# -- trade_v1 event (the contract) -----------------------------------------
# The ten required keys of the trade_v1 contract, in order.
TRADE_V1_REQUIRED = (
    "schema_version",
    "event_id",
    "source",
    "ingested_at",
    "symbol",
    "trade_id",
    "trade_ts",
    "price",
    "qty",
    "is_buyer_maker",
)
# The consumer's minimal required keys, checked in this order.
CONSUMER_REQUIRED = ("symbol", "trade_id", "trade_ts", "price", "qty")

# JSON types per key: "integer", "number", "string", "boolean".
TRADE_V1_TYPES = {
    "schema_version": "integer",
    "event_id": "string",
    "source": "string",
    "ingested_at": "string",
    "symbol": "string",
    "trade_id": "integer",
    "trade_ts": "integer",
    "price": "number",
    "qty": "number",
    "is_buyer_maker": "boolean",
}

# trade_ts must lie in these epoch milliseconds (1970 .. 9999). A
# value in seconds passes, one in micro- or nanoseconds does not.
TRADE_TS_MIN_MS = 0
TRADE_TS_MAX_MS = 253402300799999

TRADE_V1 = T.StructType(
    [
        T.StructField("schema_version", T.LongType(), False),
        T.StructField("event_id", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("ingested_at", T.StringType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("trade_id", T.LongType(), False),
        T.StructField("trade_ts", T.LongType(), False),
        T.StructField("price", T.DoubleType(), False),
        T.StructField("qty", T.DoubleType(), False),
        T.StructField("is_buyer_maker", T.BooleanType(), False),
    ]
)

# Typed partition columns of the lake (pair / trade_date / hour).
LAKE_PARTITIONS = T.StructType(
    [
        T.StructField("pair", T.StringType(), True),
        T.StructField("trade_date", T.DateType(), True),
        T.StructField("hour", T.ByteType(), True),
    ]
)
LAKE_PARTITION_COLS = ("pair", "trade_date", "hour")

# -- stream envelope (Kafka-shaped) ----------------------------------------
KAFKA_RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
    ]
)

DLQ_RECORD = T.StructType(
    [
        T.StructField("schema_version", T.IntegerType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("error", T.StringType(), False),
        T.StructField("raw", T.StringType(), False),
    ]
)

# -- staging ----------------------------------------------------------------
# Staging columns, in contract order.
STG_COLUMNS = (
    "pair",
    "trade_date",
    "hour",
    "symbol",
    "trade_id",
    "trade_ts_utc",
    "price",
    "qty",
    "is_buyer_maker",
    "ingested_at_utc",
    "event_id",
    "schema_version",
    "source",
    "trade_key",
)
# Extra ordering column (epoch ms, full precision) carried after the
# contract columns: trade_ts_utc is truncated to whole seconds, so
# first/last-trade selection needs the original milliseconds.
STG_ORDER_COL = "trade_ts_ms"

# -- marts (fixed values: names and order are the contract) ------------------
FCT_TRADES_1M = (
    "pair",
    "minute_bucket",
    "trade_count",
    "total_qty",
    "notional_usdt",
    "avg_price",
    "min_price",
    "max_price",
)
FCT_CANDLES_1M = (
    "pair",
    "minute_bucket",
    "open_price",
    "high_price",
    "low_price",
    "close_price",
    "vwap",
    "trade_count",
    "total_qty",
    "notional_usdt",
)
FCT_ORDERFLOW_1M = (
    "pair",
    "minute_bucket",
    "trade_count",
    "total_qty",
    "notional_usdt",
    "buy_qty",
    "sell_qty",
    "buy_notional_usdt",
    "sell_notional_usdt",
    "qty_imbalance",
    "notional_imbalance",
    "buy_qty_ratio",
    "sell_qty_ratio",
    "buy_notional_ratio",
    "sell_notional_ratio",
)
FCT_INGESTION_LATENCY_1M = (
    "pair",
    "minute_bucket",
    "trade_count",
    "avg_latency_s",
    "min_latency_s",
    "max_latency_s",
    "p95_latency_s",
    "p99_latency_s",
)
FCT_PIPELINE_HEALTH_5M = (
    "pair",
    "trades_last_5m",
    "max_trade_ts_utc",
    "max_ingested_at_utc",
    "seconds_since_last_trade",
    "seconds_since_last_ingest",
)

MART_COLUMNS = {
    "fct_trades_1m": FCT_TRADES_1M,
    "fct_candles_1m": FCT_CANDLES_1M,
    "fct_orderflow_1m": FCT_ORDERFLOW_1M,
    "fct_ingestion_latency_1m": FCT_INGESTION_LATENCY_1M,
    "fct_pipeline_health_5m": FCT_PIPELINE_HEALTH_5M,
}

# Not-null rules per table (data-quality checks).
NOT_NULL_RULES = {
    "stg_trades": ("pair", "trade_id", "trade_ts_utc", "price", "qty"),
    "fct_ingestion_latency_1m": ("pair", "minute_bucket"),
    "fct_pipeline_health_5m": ("pair",),
    "fct_candles_1m": ("pair", "minute_bucket"),
    "fct_orderflow_1m": ("pair", "minute_bucket"),
    "fct_trades_1m": ("pair", "minute_bucket"),
}
