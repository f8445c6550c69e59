"""Independent SQL (DuckDB dialect) for every registered query.

The same trade derivation as ``sources.testdata`` is written out in SQL
(``TRADES``/``STG`` CTEs); each mart is then the plain SQL definition.
Doubles are rounded to 6 decimals exactly like ``boundary.stable``.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-01 01:10:00'"

TRADES = """
trades AS (
  SELECT
    CAST(1 AS BIGINT)                                   AS schema_version,
    CAST(event_id AS VARCHAR)                           AS event_id,
    'synthetic'                                         AS source,
    strftime(make_timestamp(CAST((trade_ts + (event_id * 37) % 5000 - 250) * 1000 AS BIGINT)),
             '%Y-%m-%dT%H:%M:%S.%f+00:00')              AS ingested_at,
    upper(event_type)                                   AS symbol,
    event_id                                            AS trade_id,
    trade_ts,
    CAST(value AS DOUBLE)                               AS price,
    CAST(json_extract_string(props, '$.k') AS DOUBLE)   AS qty,
    (user_id % 2 = 0)                                   AS is_buyer_maker
  FROM (
    SELECT *, CAST(1704067200000 AS BIGINT)
              + (epoch_us(ts) // 1000 - CAST(1704067200000 AS BIGINT)) // 600 AS trade_ts
    FROM events
  )
)"""

STG = """
stg AS (
  SELECT
    symbol                                        AS pair,
    CAST(trade_ts_utc AS DATE)                    AS trade_date,
    CAST(hour(trade_ts_utc) AS TINYINT)           AS hour,
    symbol,
    trade_id,
    trade_ts_utc,
    price,
    qty,
    CAST(is_buyer_maker AS TINYINT)               AS is_buyer_maker,
    ingested_at_utc,
    event_id,
    CAST(schema_version AS INTEGER)               AS schema_version,
    source,
    symbol || ':' || CAST(trade_id AS VARCHAR)    AS trade_key,
    trade_ts                                      AS trade_ts_ms
  FROM (
    SELECT *,
      make_timestamp(CAST((trade_ts // 1000) * 1000000 AS BIGINT)) AS trade_ts_utc,
      try_cast(ingested_at AS TIMESTAMP)                           AS ingested_at_utc
    FROM trades
  )
  WHERE trade_ts_utc IS NOT NULL
)"""


def with_stg(body: str, *extra_ctes: str) -> str:
    ctes = [TRADES, STG, *extra_ctes]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def r(expr: str, alias: str) -> str:
    # "+ 0.0" turns a rounded -0.0 into 0.0 (Spark's round never yields -0.0)
    return f"(round({expr}, 6) + 0.0) AS {alias}"


STG_SELECT = """
SELECT pair, trade_date, hour, symbol, trade_id, trade_ts_utc,
       (round(price, 6) + 0.0) AS price, (round(qty, 6) + 0.0) AS qty, is_buyer_maker,
       ingested_at_utc, event_id, schema_version, source, trade_key, trade_ts_ms
FROM stg"""

MINUTE_AGG = """
minute_agg AS (
  SELECT
    pair,
    date_trunc('minute', trade_ts_utc)                             AS minute_bucket,
    count(*)                                                        AS trade_count,
    sum(qty)                                                        AS total_qty,
    sum(price * qty)                                                AS notional_usdt,
    avg(price)                                                      AS avg_price,
    min(price)                                                      AS min_price,
    max(price)                                                      AS max_price,
    arg_min(price, row(trade_ts_ms, trade_id))                      AS open_price,
    arg_max(price, row(trade_ts_ms, trade_id))                      AS close_price,
    sum(CASE WHEN is_buyer_maker = 0 THEN qty ELSE 0 END)           AS buy_qty,
    sum(CASE WHEN is_buyer_maker = 1 THEN qty ELSE 0 END)           AS sell_qty,
    sum(CASE WHEN is_buyer_maker = 0 THEN price * qty ELSE 0 END)   AS buy_notional_usdt,
    sum(CASE WHEN is_buyer_maker = 1 THEN price * qty ELSE 0 END)   AS sell_notional_usdt
  FROM stg
  GROUP BY 1, 2
)"""

LATENCY_AGG = """
latency_agg AS (
  SELECT
    pair,
    date_trunc('minute', trade_ts_utc)                                      AS minute_bucket,
    count(*)                                                                 AS trade_count,
    avg(CAST(lat AS DOUBLE))                                                 AS avg_latency_s,
    min(lat)                                                                 AS min_latency_s,
    max(lat)                                                                 AS max_latency_s,
    percentile_cont(0.95) WITHIN GROUP (ORDER BY lat)                        AS p95_latency_s,
    percentile_cont(0.99) WITHIN GROUP (ORDER BY lat)                        AS p99_latency_s
  FROM (
    SELECT *, date_sub('second', trade_ts_utc, ingested_at_utc) AS lat
    FROM stg
    WHERE ingested_at_utc IS NOT NULL
  )
  GROUP BY 1, 2
)"""

TRADES_COLS = f"""pair, minute_bucket, trade_count, {r('total_qty', 'total_qty')},
  {r('notional_usdt', 'notional_usdt')}, {r('avg_price', 'avg_price')},
  {r('min_price', 'min_price')}, {r('max_price', 'max_price')}"""

CANDLES_COLS = f"""pair, minute_bucket, {r('open_price', 'open_price')},
  {r('max_price', 'high_price')}, {r('min_price', 'low_price')},
  {r('close_price', 'close_price')}, {r('notional_usdt / nullif(total_qty, 0)', 'vwap')},
  trade_count, {r('total_qty', 'total_qty')}, {r('notional_usdt', 'notional_usdt')}"""

ORDERFLOW_COLS = f"""pair, minute_bucket, trade_count, {r('total_qty', 'total_qty')},
  {r('notional_usdt', 'notional_usdt')}, {r('buy_qty', 'buy_qty')}, {r('sell_qty', 'sell_qty')},
  {r('buy_notional_usdt', 'buy_notional_usdt')}, {r('sell_notional_usdt', 'sell_notional_usdt')},
  {r('buy_qty - sell_qty', 'qty_imbalance')},
  {r('buy_notional_usdt - sell_notional_usdt', 'notional_imbalance')},
  {r('buy_qty / nullif(total_qty, 0)', 'buy_qty_ratio')},
  {r('sell_qty / nullif(total_qty, 0)', 'sell_qty_ratio')},
  {r('buy_notional_usdt / nullif(notional_usdt, 0)', 'buy_notional_ratio')},
  {r('sell_notional_usdt / nullif(notional_usdt, 0)', 'sell_notional_ratio')}"""

LATENCY_COLS = f"""pair, minute_bucket, trade_count, {r('avg_latency_s', 'avg_latency_s')},
  min_latency_s, max_latency_s, {r('p95_latency_s', 'p95_latency_s')},
  {r('p99_latency_s', 'p99_latency_s')}"""

HEALTH = f"""
health AS (
  SELECT
    pair,
    count_if(trade_ts_utc >= {AS_OF} - INTERVAL 5 MINUTE)     AS trades_last_5m,
    max(trade_ts_utc)                                          AS max_trade_ts_utc,
    max(ingested_at_utc)                                       AS max_ingested_at_utc,
    date_sub('second', max(trade_ts_utc), {AS_OF})             AS seconds_since_last_trade,
    date_sub('second', max(ingested_at_utc), {AS_OF})          AS seconds_since_last_ingest
  FROM stg
  GROUP BY 1
)"""

OPEN_CLOSE = """
ends AS (
  SELECT pair, date_trunc('minute', trade_ts_utc) AS minute_bucket,
    arg_min(price, row(trade_ts_ms, trade_id)) AS open_price,
    arg_max(price, row(trade_ts_ms, trade_id)) AS close_price
  FROM stg GROUP BY ALL
)"""

LATENCY_GROUPED = """
SELECT pair, date_trunc('minute', trade_ts_utc) AS minute_bucket,
  count(*) AS trade_count,
  round(avg(CAST(s AS DOUBLE)), 6) AS avg_latency_s, min(s) AS min_latency_s, max(s) AS max_latency_s,
  (round(quantile_cont(s, 0.95), 6) + 0.0) AS p95_latency_s,
  (round(quantile_cont(s, 0.99), 6) + 0.0) AS p99_latency_s
FROM (SELECT *, date_sub('second', trade_ts_utc, ingested_at_utc) AS s FROM stg WHERE ingested_at_utc IS NOT NULL)
GROUP BY ALL"""

SLICE_START_30 = f"{AS_OF} - INTERVAL 30 MINUTE"
SLICE_START_1440 = f"{AS_OF} - INTERVAL 1440 MINUTE"

REDELIVERED = """
trades_in AS (
  SELECT * FROM trades_base
  UNION ALL
  SELECT schema_version, event_id || '-r' AS event_id, source,
         strftime(try_cast(ingested_at AS TIMESTAMP) + INTERVAL 2 SECOND,
                  '%Y-%m-%dT%H:%M:%S.%f+00:00') AS ingested_at,
         symbol, trade_id, trade_ts, price, qty, is_buyer_maker
  FROM trades_base
)"""


def with_redelivered_stg(body: str, *extra: str) -> str:
    """Like ``with_stg`` but staging reads the stream with re-deliveries."""
    base = TRADES.replace("trades AS (", "trades_base AS (", 1)
    stg = STG.replace("FROM trades\n", "FROM trades_in\n")
    return "WITH " + ",\n".join([base, REDELIVERED, stg, *extra]) + "\n" + body


def not_null_sql(table: str, cols) -> str:
    parts = [
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, 'not_null' AS check_name, "
        f"CAST(count_if({c} IS NULL) AS BIGINT) AS failures FROM {table}"
        for c in cols
    ]
    return "\nUNION ALL\n".join(parts)


QUALITY_TABLES = f"""
fct_trades_1m AS (SELECT pair, minute_bucket FROM minute_agg),
fct_candles_1m AS (SELECT pair, minute_bucket FROM minute_agg),
fct_orderflow_1m AS (SELECT pair, minute_bucket FROM minute_agg),
fct_ingestion_latency_1m AS (SELECT pair, minute_bucket FROM latency_agg),
fct_pipeline_health_5m AS (SELECT pair FROM health),
stg_trades AS (SELECT * FROM stg)"""


def _quality_body() -> str:
    from ticklake.schema import NOT_NULL_RULES

    return "\nUNION ALL\n".join(not_null_sql(t, cols) for t, cols in NOT_NULL_RULES.items())


CHECKED = """
checked AS (
  SELECT *,
    CASE trade_id % 17
      WHEN 0 THEN 'missing_key:price'
      WHEN 1 THEN 'type:price'
      WHEN 2 THEN 'type:trade_id'
      WHEN 4 THEN 'type:is_buyer_maker'
      WHEN 5 THEN 'type:trade_ts'
      WHEN 6 THEN 'type:symbol'
      WHEN 7 THEN 'invalid_json'
      WHEN 8 THEN 'not_object'
      WHEN 10 THEN 'missing_key:symbol'
      WHEN 13 THEN 'range:trade_ts'
      WHEN 14 THEN 'range:trade_ts'
      WHEN 15 THEN 'range:trade_ts'
      WHEN 16 THEN 'range:trade_ts'
    END AS error,
    CAST(trade_id % 3 AS INTEGER) AS partition,
    trade_id AS "offset"
  FROM trades
)"""

CONTRACT_SELECT = """
SELECT "offset", partition, error,
  CASE WHEN error IS NULL THEN schema_version END AS schema_version,
  CASE WHEN error IS NULL THEN event_id END AS event_id,
  CASE WHEN error IS NULL THEN source END AS source,
  CASE WHEN error IS NULL THEN ingested_at END AS ingested_at,
  CASE WHEN error IS NULL THEN upper(symbol) END AS symbol,
  CASE WHEN error IS NULL THEN trade_id END AS trade_id,
  CASE WHEN error IS NULL THEN trade_ts END AS trade_ts,
  CASE WHEN error IS NULL THEN round(price, 6) END AS price,
  CASE WHEN error IS NULL THEN round(qty, 6) END AS qty,
  CASE WHEN error IS NULL THEN is_buyer_maker END AS is_buyer_maker
FROM checked"""

DLQ_SELECT = """
SELECT 'crypto.trades.v1:' || CAST(partition AS VARCHAR) AS key,
  to_json({'schema_version': 1, 'source': 'crypto-consumer', 'error': error, 'raw': raw}) AS value,
  'crypto.trades.v1' AS topic, partition, "offset", make_timestamp(trade_ts * 1000) AS "timestamp"
FROM (
  SELECT *,
    CASE trade_id % 17
      WHEN 7 THEN '{bad' || event_id
      WHEN 8 THEN '[' || CAST(trade_id AS VARCHAR) || ']'
      ELSE substring('{"schema_version":1,"event_id":"' || event_id || '","source":"synthetic","ingested_at":"'
                     || ingested_at || '"', 1, 60) || '...<truncated>'
    END AS raw
  FROM checked WHERE error IS NOT NULL
)"""

INGEST_COUNTS = """
SELECT 'crypto.trades.v1' AS topic, partition, count(*) AS consumed,
  count_if(error IS NULL) AS landed, count_if(error IS NOT NULL) AS dead_lettered,
  max("offset") + 1 AS next_offset
FROM checked GROUP BY partition"""

DLQ_RATE = """
SELECT interval_start, CAST(sum(good) AS BIGINT) AS landed, CAST(sum(bad) AS BIGINT) AS dead_lettered,
  round(sum(bad) / (sum(good) + sum(bad)), 6) AS dlq_rate
FROM (
  SELECT make_timestamp((epoch_us(try_cast(ingested_at AS TIMESTAMP)) // 600000000) * 600000000) AS interval_start,
         1 AS good, 0 AS bad
  FROM checked WHERE error IS NULL
  UNION ALL
  SELECT make_timestamp(((trade_ts * 1000) // 600000000) * 600000000), 0, 1
  FROM checked WHERE error IS NOT NULL
)
GROUP BY 1"""

NORMALIZE_SELECT = """
SELECT CAST(1 AS BIGINT) AS schema_version, 'binance_ws' AS source, symbol, trade_id, trade_ts,
  (round(price, 6) + 0.0) AS price, (round(qty, 6) + 0.0) AS qty, is_buyer_maker,
  TRUE AS event_id_ok, TRUE AS ingested_ok
FROM trades"""

PARTITION_VALUES = """
SELECT trade_id,
  strftime(make_timestamp(trade_ts * 1000), '%Y-%m-%d') AS trade_date,
  strftime(make_timestamp(trade_ts * 1000), '%H') AS hour
FROM trades"""


def with_trades(body: str, *extra: str) -> str:
    return "WITH " + ",\n".join([TRADES, *extra]) + "\n" + body


LAKE_SELECT = """
SELECT schema_version, event_id, source, ingested_at, symbol, trade_id, trade_ts,
  (round(price, 6) + 0.0) AS price, (round(qty, 6) + 0.0) AS qty, is_buyer_maker,
  upper(symbol) AS pair,
  CAST(make_timestamp(trade_ts * 1000) AS DATE) AS trade_date,
  CAST(hour(make_timestamp(trade_ts * 1000)) AS TINYINT) AS hour
FROM trades"""

RANGE_MS = ("epoch_ms(TIMESTAMP '2024-01-01 00:30:00')", "epoch_ms(TIMESTAMP '2024-01-01 00:45:00')")

SNAPSHOT = f"""
SELECT {CANDLES_COLS}, TIMESTAMP '2024-01-01 00:30:00' AS snapshot_ts
FROM minute_agg"""

WIDE_COLS = f"""{CANDLES_COLS}, {r('avg_price', 'avg_price')},
  {r('buy_qty', 'buy_qty')}, {r('sell_qty', 'sell_qty')},
  {r('buy_notional_usdt', 'buy_notional_usdt')}, {r('sell_notional_usdt', 'sell_notional_usdt')},
  {r('buy_qty - sell_qty', 'qty_imbalance')},
  {r('buy_notional_usdt - sell_notional_usdt', 'notional_imbalance')},
  {r('buy_qty / nullif(total_qty, 0)', 'buy_qty_ratio')},
  {r('sell_qty / nullif(total_qty, 0)', 'sell_qty_ratio')},
  {r('buy_notional_usdt / nullif(notional_usdt, 0)', 'buy_notional_ratio')},
  {r('sell_notional_usdt / nullif(notional_usdt, 0)', 'sell_notional_ratio')},
  l.trade_count AS latency_count, {r('l.avg_latency_s', 'avg_latency_s')},
  l.min_latency_s, l.max_latency_s, {r('l.p95_latency_s', 'p95_latency_s')},
  {r('l.p99_latency_s', 'p99_latency_s')}"""

STREAM_MARTS = f"""
SELECT {WIDE_COLS.replace('trade_count,', 'm.trade_count AS trade_count,', 1).replace('pair, minute_bucket,', 'm.pair, m.minute_bucket,', 1)}
FROM minute_agg m LEFT JOIN latency_agg l ON m.pair = l.pair AND m.minute_bucket = l.minute_bucket"""

# averages lifted above ties at the 6th decimal, as the queries do
WHOLE_MARTS = STREAM_MARTS.replace("round(avg_price, 6)", "round(avg_price + 1e-9, 6)")

ROLLING = """
SELECT pair, window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) AS trade_count
FROM (
  SELECT pair, date_trunc('minute', trade_ts_utc) - k * INTERVAL 1 MINUTE AS window_start
  FROM (SELECT pair, trade_ts_utc, unnest(generate_series(0, 4)) AS k FROM stg)
)
GROUP BY 1, 2"""


ORACLE_SQL: dict[str, str] = {
    "stg_trades": with_stg(STG_SELECT),
    "fct_trades_1m": with_stg(f"SELECT {TRADES_COLS} FROM minute_agg", MINUTE_AGG),
    "fct_candles_1m": with_stg(f"SELECT {CANDLES_COLS} FROM minute_agg", MINUTE_AGG),
    "fct_orderflow_1m": with_stg(f"SELECT {ORDERFLOW_COLS} FROM minute_agg", MINUTE_AGG),
    "fct_ingestion_latency_1m": with_stg(f"SELECT {LATENCY_COLS} FROM latency_agg", LATENCY_AGG),
    "fct_pipeline_health_5m": with_stg("SELECT * FROM health", HEALTH),
    "open_close_row_number": with_stg(
        "SELECT pair, minute_bucket, (round(open_price, 6) + 0.0) AS open_price, "
        "(round(close_price, 6) + 0.0) AS close_price FROM ends", OPEN_CLOSE),
    "candles_window_join_form": with_stg(f"SELECT {CANDLES_COLS} FROM minute_agg", MINUTE_AGG),
    "latency_window_distinct_form": with_stg(LATENCY_GROUPED),
    "list_pairs": with_stg(
        "SELECT pair FROM (SELECT DISTINCT pair FROM minute_agg "
        "UNION ALL SELECT 'BTCUSDT' WHERE NOT EXISTS (SELECT 1 FROM minute_agg)) ORDER BY 1",
        MINUTE_AGG),
    "candles_slice": with_stg(
        f"SELECT {CANDLES_COLS} FROM minute_agg WHERE pair = 'CLICK' "
        f"AND minute_bucket >= {SLICE_START_30} ORDER BY minute_bucket", MINUTE_AGG),
    "orderflow_slice": with_stg(
        f"SELECT pair, minute_bucket, {r('buy_qty - sell_qty', 'qty_imbalance')}, "
        f"{r('buy_qty / nullif(total_qty, 0)', 'buy_qty_ratio')} FROM minute_agg "
        f"WHERE pair = 'CLICK' AND minute_bucket >= {SLICE_START_30} ORDER BY minute_bucket",
        MINUTE_AGG),
    "trades_slice_top200": with_stg(
        f"SELECT {TRADES_COLS} FROM minute_agg WHERE pair = 'CLICK' "
        f"AND minute_bucket >= {SLICE_START_1440} ORDER BY minute_bucket DESC LIMIT 200",
        MINUTE_AGG),
    "latest_candles_top5": with_stg(
        f"SELECT {CANDLES_COLS} FROM minute_agg ORDER BY minute_bucket DESC, pair LIMIT 5", MINUTE_AGG),
    "latest_orderflow_top5": with_stg(
        f"SELECT {ORDERFLOW_COLS} FROM minute_agg ORDER BY minute_bucket DESC, pair LIMIT 5", MINUTE_AGG),
    "latest_trades_top5": with_stg(
        f"SELECT {TRADES_COLS} FROM minute_agg ORDER BY minute_bucket DESC, pair LIMIT 5", MINUTE_AGG),
    "latest_latency_top5": with_stg(
        f"SELECT {LATENCY_COLS} FROM latency_agg ORDER BY minute_bucket DESC, pair LIMIT 5", LATENCY_AGG),
    "health_top5": with_stg("SELECT * FROM health ORDER BY pair LIMIT 5", HEALTH),
    "latest_candle_per_pair": with_stg(
        f"SELECT {CANDLES_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY pair "
        f"ORDER BY minute_bucket DESC) AS rn FROM minute_agg) WHERE rn = 1", MINUTE_AGG),
    "latest_candle_stats": with_stg(
        f"SELECT pair, minute_bucket, trade_count, {r('total_qty', 'total_qty')}, "
        f"{r('notional_usdt', 'notional_usdt')}, {r('notional_usdt / nullif(total_qty, 0)', 'vwap')} "
        f"FROM minute_agg WHERE pair = 'CLICK' AND minute_bucket >= {SLICE_START_30} "
        f"ORDER BY minute_bucket DESC LIMIT 1", MINUTE_AGG),
    "quality_not_null": with_stg(_quality_body(), MINUTE_AGG, LATENCY_AGG, HEALTH, QUALITY_TABLES),
    "quality_unique_trade_key": with_redelivered_stg(
        "SELECT trade_key, count(*) AS n_rows FROM stg GROUP BY 1 HAVING count(*) > 1"),
    "dedupe_trades": with_redelivered_stg(
        "SELECT pair, trade_date, hour, symbol, trade_id, trade_ts_utc, (round(price, 6) + 0.0) AS price, "
        "(round(qty, 6) + 0.0) AS qty, is_buyer_maker, ingested_at_utc, event_id, schema_version, source, "
        "trade_key, trade_ts_ms FROM (SELECT *, row_number() OVER (PARTITION BY trade_key "
        "ORDER BY ingested_at_utc ASC NULLS LAST, event_id ASC) AS rn FROM stg) WHERE rn = 1"),
    "contract_check": with_trades(CONTRACT_SELECT, CHECKED),
    "dlq_payload": with_trades(DLQ_SELECT, CHECKED),
    "ingest_counts": with_trades(INGEST_COUNTS, CHECKED),
    "dlq_rate_10m": with_trades(DLQ_RATE, CHECKED),
    "normalize_feed": with_trades(NORMALIZE_SELECT),
    "partition_values": with_trades(PARTITION_VALUES),
    "lake_roundtrip": with_trades(LAKE_SELECT),
    "lake_range_read": with_trades(
        LAKE_SELECT + f" WHERE trade_ts >= {RANGE_MS[0]} AND trade_ts < {RANGE_MS[1]}"),
    "external_table_scan": with_trades(LAKE_SELECT),
    "lake_compaction": with_trades(LAKE_SELECT),
    "refresh_roundtrip": with_stg(f"SELECT {CANDLES_COLS} FROM minute_agg", MINUTE_AGG),
    "refresh_incremental": with_stg("SELECT * FROM health", HEALTH),
    "asof_snapshot": with_stg(SNAPSHOT, MINUTE_AGG.replace(
        "FROM stg", "FROM stg WHERE trade_ts_utc < TIMESTAMP '2024-01-01 00:30:00'")),
    "stream_minute_marts": with_stg(STREAM_MARTS, MINUTE_AGG, LATENCY_AGG),
    "stream_dedupe": with_redelivered_stg(
        "SELECT DISTINCT pair, trade_id, trade_ts_utc, (round(price, 6) + 0.0) AS price, (round(qty, 6) + 0.0) AS qty, "
        "is_buyer_maker, trade_key FROM stg"),
    "rolling_activity_5m": with_stg(ROLLING),
}


# -- whole jobs ---------------------------------------------------------------

MINIMAL = """
SELECT "offset", partition, error,
  CASE WHEN error IS NULL THEN symbol END AS symbol, CASE WHEN error IS NULL THEN trade_id END AS trade_id,
  CASE WHEN error IS NULL THEN trade_ts END AS trade_ts, CASE WHEN error IS NULL THEN round(price, 6) END AS price,
  CASE WHEN error IS NULL THEN round(qty, 6) END AS qty
FROM (
  SELECT trade_id AS "offset", CAST(trade_id % 3 AS INTEGER) AS partition, *,
    CASE trade_id % 17
      WHEN 0 THEN 'missing_key:price' WHEN 5 THEN 'type:trade_ts' WHEN 6 THEN 'type:symbol' WHEN 7 THEN 'invalid_json'
      WHEN 8 THEN 'not_object' WHEN 10 THEN 'missing_key:symbol'
      WHEN 13 THEN 'range:trade_ts' WHEN 14 THEN 'range:trade_ts' WHEN 15 THEN 'range:trade_ts' WHEN 16 THEN 'range:trade_ts'
    END AS error
  FROM trades)"""

LANDED_DLQ = """
SELECT 'crypto.trades.v1:' || CAST(partition AS VARCHAR) AS key, 'crypto.trades.v1' AS topic, partition, "offset", error,
  TRUE AS payload_whole
FROM checked WHERE error IS NOT NULL"""

# every second trade on the next day
TWO_DAYS = STG.replace("stg AS (", "stg AS (", 1).replace(
    "FROM trades\n", "FROM (SELECT * REPLACE (trade_ts + CASE WHEN trade_id % 2 = 1 THEN 86400000 ELSE 0 END AS trade_ts) FROM trades)\n")

CATALOG = """
SELECT 'fct_trades_1m' AS mart, pair, minute_bucket AS "at", trade_count AS n FROM minute_agg
UNION ALL SELECT 'fct_candles_1m', pair, minute_bucket, trade_count FROM minute_agg
UNION ALL SELECT 'fct_orderflow_1m', pair, minute_bucket, trade_count FROM minute_agg
UNION ALL SELECT 'fct_ingestion_latency_1m', pair, minute_bucket, trade_count FROM latency_agg
UNION ALL SELECT 'fct_pipeline_health_5m', pair, max_trade_ts_utc, CAST(trades_last_5m AS BIGINT) FROM health"""

FEED = """
feed AS (
  SELECT *, CASE trade_id % 7 WHEN 0 THEN 'invalid_json' WHEN 1 THEN 'missing_key:p' WHEN 2 THEN 'type:price'
      WHEN 3 THEN 'type:trade_ts' WHEN 4 THEN 'range:trade_ts' END AS error
  FROM trades
)"""

_SLICE = "pair = 'CLICK' AND minute_bucket >="

ORACLE_SQL |= {
    "contract_minimal": with_trades(MINIMAL),
    "stream_land_lake": with_trades(LAKE_SELECT.replace("FROM trades", "FROM checked WHERE error IS NULL"), CHECKED),
    "land_crash_replay": with_trades(LAKE_SELECT.replace("FROM trades", "FROM checked WHERE error IS NULL"), CHECKED),
    "late_split": with_stg(WHOLE_MARTS, MINUTE_AGG, LATENCY_AGG),
    "stream_minute_counts": with_stg(WHOLE_MARTS, MINUTE_AGG, LATENCY_AGG),
    "stream_rolling_activity": with_stg(ROLLING),
    "stream_land_dlq": with_trades(LANDED_DLQ, CHECKED),
    "land_compact_read": with_trades(LAKE_SELECT),
    "land_external_table": with_trades(LAKE_SELECT),
    "compact_concurrent": with_trades(LAKE_SELECT),
    "plain_table_range": with_trades(
        LAKE_SELECT + f" WHERE upper(symbol) = 'CLICK' AND trade_ts >= {RANGE_MS[0]} AND trade_ts < {RANGE_MS[1]}"),
    "drifted_files": with_trades(LAKE_SELECT.replace("FROM trades", """FROM (
      SELECT * REPLACE (CASE WHEN trade_id % 3 = 1 THEN floor(price) ELSE price END AS price,
                        CASE WHEN trade_id % 3 = 1 THEN floor(qty) ELSE qty END AS qty) FROM trades)""")),
    "staging_view": with_stg(STG_SELECT.replace(", trade_ts_ms", "")),
    "catalog_after_incremental": "WITH " + ",\n".join([TRADES, TWO_DAYS, MINUTE_AGG, LATENCY_AGG, HEALTH]) + CATALOG,
    "health_table": with_stg("SELECT * FROM health ORDER BY pair", HEALTH),
    "missing_marts": "SELECT unnest(['fct_orderflow_1m', 'fct_trades_1m']) AS mart",
    "nightly_checks": with_stg(
        _quality_body() + "\nUNION ALL\nSELECT 'stg_trades', 'trade_key', 'unique', "
        "(SELECT count(*) FROM (SELECT trade_key FROM stg GROUP BY 1 HAVING count(*) > 1))",
        MINUTE_AGG, LATENCY_AGG, HEALTH, QUALITY_TABLES),
    "candles_slice_stored": with_stg(f"SELECT {CANDLES_COLS} FROM minute_agg WHERE {_SLICE} {SLICE_START_30}", MINUTE_AGG),
    "orderflow_slice_stored": ORACLE_SQL["orderflow_slice"],
    "trades_slice_stored": with_stg(
        f"SELECT {TRADES_COLS} FROM minute_agg WHERE {_SLICE} {SLICE_START_1440} ORDER BY minute_bucket DESC LIMIT 20", MINUTE_AGG),
    "late_reconciled": with_stg(WHOLE_MARTS, MINUTE_AGG, LATENCY_AGG),
    "stream_dedupe_earliest": ORACLE_SQL["dedupe_trades"],
    "refresh_merged": with_stg(WHOLE_MARTS, MINUTE_AGG, LATENCY_AGG),
    "refresh_merged_health": with_stg("SELECT * FROM health", HEALTH),
    "scheduled_refresh": with_stg(WHOLE_MARTS, MINUTE_AGG, LATENCY_AGG),
    "unkeyed_range_read": ORACLE_SQL["lake_range_read"],
    "publish_feed": with_trades(
        "SELECT symbol AS key, symbol, trade_id, trade_ts, (round(price, 6) + 0.0) AS price, (round(qty, 6) + 0.0) AS qty, "
        "is_buyer_maker FROM feed WHERE error IS NULL", FEED),
    "publish_dlq": with_trades(
        """SELECT 'feed:0' AS key, error, CASE WHEN error = 'invalid_json' THEN '{nope' || trade_id ELSE
          '{"e":"trade","E":' || (trade_ts + 5) || ',"s":"' || symbol || '","t":' || trade_id
          || CASE error WHEN 'missing_key:p' THEN '' WHEN 'type:price' THEN ',"p":"x"' ELSE ',"p":"' || price || '"' END
          || ',"q":"' || qty || '","T":' || CASE error WHEN 'type:trade_ts' THEN 'null'
             WHEN 'range:trade_ts' THEN trade_ts || '000000' ELSE trade_ts || '' END
          || ',"m":' || is_buyer_maker || '}' END AS text
        FROM feed WHERE error IS NOT NULL""", FEED),
    "refresh_deduped": with_stg(f"SELECT {CANDLES_COLS} FROM minute_agg", MINUTE_AGG),
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
