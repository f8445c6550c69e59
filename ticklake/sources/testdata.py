"""Test-data adapter: derive a trade stream from the driver's ``events`` table.

The test tables hold no trades, so every ``events`` row becomes one
trade_v1 event. Time is compressed 600x around 2024-01-01T00:00Z so a
month of events fills ~72 minutes and every (pair, minute) bucket is
populated. The derivation is a fixed definition shared with the SQL
oracle (it must produce the same rows in both engines):

* ``trade_ts``  = B + (epoch_ms(ts) - B) div 600, B = 1704067200000
* ``trade_id``  = event_id; ``event_id`` = its text
* ``symbol``    = upper(event_type)
* ``price``     = value; ``qty`` = props ``$.k`` as double
* ``is_buyer_maker`` = user_id is even
* ``ingested_at``    = ISO text of trade_ts + (event_id*37) % 5000 - 250 ms
* ``source`` = 'synthetic', ``schema_version`` = 1
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.functions.time import epoch_ms_to_ts, iso_utc_string

# Fixed values of the adapter definition (shared with the SQL oracle).
BASE_MS = 1704067200000
TIME_COMPRESSION = 600
INGEST_SPREAD_MS = 5000
INGEST_SHIFT_MS = 250
INGEST_MULTIPLIER = 37
SOURCE = "synthetic"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trades_from_events(events: DataFrame) -> DataFrame:
    """``events`` -> trade_v1 rows (raw contract types)."""
    ms = F.call_function(
        "div", F.unix_micros(F.col("ts").cast("timestamp")), F.lit(1000)
    )
    trade_ts = F.lit(BASE_MS) + F.call_function(
        "div", ms - F.lit(BASE_MS), F.lit(TIME_COMPRESSION)
    )
    ingest_ms = (
        F.col("trade_ts")
        + (F.col("event_id") * INGEST_MULTIPLIER) % INGEST_SPREAD_MS
        - INGEST_SHIFT_MS
    )
    return (
        events.select(
            "event_id", "user_id", "event_type", "value", "props",
            trade_ts.alias("trade_ts"),
        )
        .select(
            F.lit(1).cast("bigint").alias("schema_version"),
            F.col("event_id").cast("string").alias("event_id"),
            F.lit(SOURCE).alias("source"),
            iso_utc_string(epoch_ms_to_ts(ingest_ms)).alias("ingested_at"),
            F.upper("event_type").alias("symbol"),
            F.col("event_id").alias("trade_id"),
            F.col("trade_ts"),
            F.col("value").cast("double").alias("price"),
            F.get_json_object("props", "$.k").cast("double").alias("qty"),
            ((F.col("user_id") % 2) == 0).alias("is_buyer_maker"),
        )
    )


def load_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade events of a test-data directory."""
    return trades_from_events(read_table(spark, sf_dir, "events"))


# Fixed value: a re-delivered copy arrives this many seconds after the original.
REDELIVERY_DELAY_S = 2


def with_redelivery(trades: DataFrame) -> DataFrame:
    """At-least-once delivery: every trade arrives twice — the original and
    a copy re-sent ``REDELIVERY_DELAY_S`` later under a new event id."""
    from ticklake.functions.time import iso_to_ts

    again = trades.select(
        "schema_version",
        F.concat(F.col("event_id"), F.lit("-r")).alias("event_id"),
        "source",
        iso_utc_string(
            iso_to_ts("ingested_at") + F.make_interval(secs=F.lit(REDELIVERY_DELAY_S))
        ).alias("ingested_at"),
        "symbol", "trade_id", "trade_ts", "price", "qty", "is_buyer_maker",
    )
    return trades.unionByName(again)


# Topic names of the trade stream and its dead-letter
# stream, and the trade topic's partition count.
TRADES_TOPIC = "crypto.trades.v1"
DLQ_TOPIC = "crypto.trades.dlq.v1"
TOPIC_PARTITIONS = 3
# Damage fixture: trade_id % DAMAGE_CYCLE selects how a payload is damaged.
DAMAGE_CYCLE = 17

_JSON_OPTS = {"ignoreNullFields": "false"}


def _event_json(**override) -> Column:
    """to_json of a trade_v1 struct with some fields replaced or dropped."""
    cols = []
    for k in (
        "schema_version", "event_id", "source", "ingested_at", "symbol",
        "trade_id", "trade_ts", "price", "qty", "is_buyer_maker",
    ):
        if k in override:
            if override[k] is None:
                continue
            cols.append(override[k].alias(k))
        else:
            cols.append(F.col(k))
    extra = override.get("_extra")
    if extra is not None:
        cols.append(extra.alias("venue"))
    return F.to_json(F.struct(*cols), _JSON_OPTS)


def damaged_payload(trades: DataFrame) -> Column:
    """JSON payload per trade, damaged according to ``trade_id % 17``:

    0 price missing; 1 price as text; 2 trade_id 1.5-style; 3 trade_id
    written as a whole float (valid); 4 is_buyer_maker as 0/1; 5 trade_ts
    null; 6 symbol null; 7 not JSON; 8 a JSON array; 9 an extra key
    (valid); 10 symbol and qty missing; 11, 12 intact; 13 trade_ts in
    nanoseconds; 14 in microseconds; 15 negative; 16 the largest BIGINT.
    """
    d = F.col("trade_id") % DAMAGE_CYCLE
    return (
        F.when(d == 0, _event_json(price=None))
        .when(d == 1, _event_json(price=F.col("price").cast("string")))
        .when(d == 2, _event_json(trade_id=F.col("trade_id") + F.lit(0.5)))
        .when(d == 3, _event_json(trade_id=F.col("trade_id").cast("double")))
        .when(d == 4, _event_json(is_buyer_maker=F.col("is_buyer_maker").cast("int")))
        .when(d == 5, _event_json(trade_ts=F.lit(None).cast("bigint")))
        .when(d == 6, _event_json(symbol=F.lit(None).cast("string")))
        .when(d == 7, F.concat(F.lit("{bad"), F.col("event_id")))
        .when(d == 8, F.concat(F.lit("["), F.col("trade_id").cast("string"), F.lit("]")))
        .when(d == 9, _event_json(_extra=F.lit("spot")))
        .when(d == 10, _event_json(symbol=None, qty=None))
        .when(d == 13, _event_json(trade_ts=F.col("trade_ts") * 1_000_000))
        .when(d == 14, _event_json(trade_ts=F.col("trade_ts") * 1_000))
        .when(d == 15, _event_json(trade_ts=-F.col("trade_ts")))
        .when(d == 16, _event_json(trade_ts=F.lit((1 << 63) - 1)))
        .otherwise(_event_json())
    )


def kafka_records(trades: DataFrame, damaged: bool = True) -> DataFrame:
    """Trades as Kafka-shaped records of the trade topic (key = symbol)."""
    payload = damaged_payload(trades) if damaged else _event_json()
    return trades.select(
        F.col("symbol").cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
        F.lit(TRADES_TOPIC).alias("topic"),
        (F.col("trade_id") % TOPIC_PARTITIONS).cast("int").alias("partition"),
        F.col("trade_id").alias("offset"),
        F.timestamp_millis("trade_ts").alias("timestamp"),
    )


def feed_messages(trades: DataFrame) -> DataFrame:
    """Trades as raw exchange messages (``e,E,s,t,p,q,T,m``; p/q as text)."""
    text = F.format_string(
        '{"e":"trade","E":%d,"s":"%s","t":%d,"p":"%s","q":"%s","T":%d,"m":%s}',
        F.col("trade_ts") + 5,
        F.col("symbol"),
        F.col("trade_id"),
        F.col("price").cast("string"),
        F.col("qty").cast("string"),
        F.col("trade_ts"),
        F.when(F.col("is_buyer_maker"), F.lit("true")).otherwise(F.lit("false")),
    )
    return trades.select(text.alias("value"), F.col("trade_id").alias("offset"))


def events_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """``events`` as a file stream: one file, or a folder of part files."""
    schema = read_table(spark, sf_dir, "events").schema
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    # a glob: a plain file path would be taken for the folder of a table
    return r.parquet(f"{sf_dir.rstrip('/')}/events.parque[t]")
