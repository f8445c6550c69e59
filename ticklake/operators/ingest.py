"""Ingest transforms: feed normalisation, JSON contract, DLQ routing.

Records arrive Kafka-shaped (``key, value, topic, partition, offset``).
The payload is parsed once into a VARIANT; the contract is then checked
key by key with case-exact paths, so the three failure kinds stay
distinct: a key that is *missing*, present but *null*, or of the
*wrong type*. Everything is a per-row projection (no shuffle); good
and bad rows are split by the ``error`` column.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.functions.time import iso_utc_string, partition_values
from ticklake.schema import (
    CONSUMER_REQUIRED,
    TRADE_TS_MAX_MS,
    TRADE_TS_MIN_MS,
    TRADE_V1,
    TRADE_V1_REQUIRED,
    TRADE_V1_TYPES,
)

# Producer source tag, DLQ envelope source tag, DLQ raw cap
# (bytes) and the marker appended to a truncated payload.
FEED_SOURCE = "binance_ws"
DLQ_SOURCE = "crypto-consumer"
DLQ_MAX_BYTES = 200_000
TRUNCATION_MARK = "...<truncated>"
SCHEMA_VERSION = 1

# Error codes written to the ``error`` column / DLQ payload.
ERR_INVALID_JSON = "invalid_json"
ERR_NOT_OBJECT = "not_object"
ERR_RANGE = "range:trade_ts"

FULL = "full"        # all ten trade_v1 keys, with JSON types
MINIMAL = "minimal"  # the consumer's five keys: present and castable

_INT_TYPES = ("BIGINT", "INT", "SMALLINT", "TINYINT")


def payload_text(value: Column) -> Column:
    """Bytes/text -> valid UTF-8 text (bad bytes become U+FFFD)."""
    return F.make_valid_utf8(value.cast("string"))


def _path(k: str) -> str:
    return f"$.{k}"


def _fcol(k: str) -> str:
    return f"_f_{k}"


def _tcol(k: str) -> str:
    return f"_t_{k}"


def _is_type(k: str, json_type: str) -> Column:
    """JSON-Schema type test on the extracted value of ``k`` (null fails)."""
    t = F.col(_tcol(k))
    if json_type == "string":
        return t == "STRING"
    if json_type == "boolean":
        return t == "BOOLEAN"
    numeric = t.isin(*_INT_TYPES) | t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT")
    if json_type == "number":
        return numeric
    if json_type == "integer":
        # 1.0 is an integer in JSON Schema; 1.5 is not; values must fit BIGINT.
        f = F.col(_fcol(k))
        as_long = F.try_variant_get(f, "$", "bigint")
        whole = F.try_variant_get(f, "$", "double") == as_long.cast("double")
        return t.isin(*_INT_TYPES) | (numeric & F.coalesce(whole, F.lit(False)))
    raise ValueError(json_type)


def _contract_error(keys: Sequence[str], mode: str) -> Column:
    v = F.col("_v")
    is_object = F.schema_of_variant(v).startswith("OBJECT")
    branches = F.when(v.isNull(), F.lit(ERR_INVALID_JSON)).when(~is_object, F.lit(ERR_NOT_OBJECT))
    for k in keys:
        # A JSON null is present (a VARIANT null), a missing key is SQL NULL.
        branches = branches.when(F.col(_fcol(k)).isNull(), F.lit(f"missing_key:{k}"))
    for k in keys:
        if mode == FULL:
            bad = ~_is_type(k, TRADE_V1_TYPES[k])
        else:  # nothing may turn into NULL on the way to the lake
            bad = F.try_variant_get(F.col(_fcol(k)), "$", TRADE_V1[k].dataType.simpleString()).isNull()
        branches = branches.when(bad, F.lit(f"type:{k}"))
    ts = F.try_variant_get(F.col(_fcol("trade_ts")), "$", "bigint")
    return branches.when(~ts.between(TRADE_TS_MIN_MS, TRADE_TS_MAX_MS), F.lit(ERR_RANGE))


METRICS_NAME = "ingest_metrics"


def check_contract(records: DataFrame, mode: str = FULL, value_col: str = "value",
                   metrics_name: str | None = "") -> DataFrame:
    """Parse and check each record; add the typed trade_v1 fields + ``error``.

    ``error`` is NULL when the payload satisfies the contract, else one of
    ``invalid_json``, ``not_object``, ``missing_key:<k>`` (first missing
    key in contract order), ``type:<k>`` (first wrong JSON type; in MINIMAL
    mode the first required key that does not cast) or ``range:trade_ts``
    (not epoch milliseconds of the years 1970 to 9999). Keeps the envelope columns; typed fields are NULL on
    failing rows. ``symbol`` is upper-cased (pairs compare
    case-insensitively). Unknown keys are dropped.

    The payload is parsed once and every key is extracted once (one
    projection each), so per-row cost is one parse + one lookup per key.

    The result carries per-query counters (``observe``: consumed /
    landed / dead_lettered) under ``metrics_name`` (default: a unique
    name per call, so several checks can share one plan; ``None``: no
    counters, e.g. on an already persisted batch). The observation node
    also keeps a later ``where(error ...)`` above the check: without it
    Catalyst pushes that filter through the projections and inlines the
    parse into every reference (tens of parses per row).
    """
    keys = TRADE_V1_REQUIRED if mode == FULL else CONSUMER_REQUIRED
    env = list(records.columns)
    parsed = records.select(*env, F.try_parse_json(payload_text(F.col(value_col))).alias("_v"))
    extracted = parsed.select(
        *env, "_v", *[F.variant_get(F.col("_v"), _path(k), "variant").alias(_fcol(k)) for k in TRADE_V1_REQUIRED]
    )
    typed = extracted.select(
        "*", *[F.schema_of_variant(F.col(_fcol(k))).alias(_tcol(k)) for k in TRADE_V1_REQUIRED]
    )
    checked = typed.select(*env, "_v", _contract_error(keys, mode).alias("error"))
    # Typed fields of passing rows: one cast of the object to the trade_v1
    # struct (fields matched by exact key; unknown keys dropped).
    row = F.when(F.col("error").isNull(), F.try_variant_get(F.col("_v"), "$", TRADE_V1.simpleString()))
    fields = [
        (F.upper(F.col(f"_r.{k}")) if k == "symbol" else F.col(f"_r.{k}")).alias(k) for k in TRADE_V1_REQUIRED
    ]
    out = checked.select(*env, row.alias("_r"), "error").select(*env, *fields, "error")
    if metrics_name == "":
        metrics_name = f"{METRICS_NAME}_{uuid.uuid4().hex[:8]}"
    if metrics_name:
        out = out.observe(
            metrics_name,
            F.count(F.lit(1)).alias("consumed"),
            F.count_if(F.col("error").isNull()).alias("landed"),
            F.count_if(F.col("error").isNotNull()).alias("dead_lettered"),
        )
    return out


def good_rows(checked: DataFrame) -> DataFrame:
    """Rows that passed: the trade_v1 columns only."""
    return checked.where(F.col("error").isNull()).select(*TRADE_V1_REQUIRED)


def bad_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("error").isNotNull())


def dlq_raw(value: Column, max_bytes: int = DLQ_MAX_BYTES) -> Column:
    """Payload text for the DLQ: '' for NULL/empty; over ``max_bytes`` UTF-8
    bytes -> first ``max_bytes // 2`` characters + the truncation mark."""
    raw = F.coalesce(payload_text(value), F.lit(""))
    return F.when(
        F.octet_length(raw) > max_bytes,
        F.concat(F.substring(raw, 1, max_bytes // 2), F.lit(TRUNCATION_MARK)),
    ).otherwise(raw)


def to_dlq(bad: DataFrame, max_bytes: int = DLQ_MAX_BYTES, source: str = DLQ_SOURCE,
           value_col: str = "value", whole: bool = False) -> DataFrame:
    """Bad records -> DLQ records ``key = topic:partition``, JSON ``value``.

    The envelope cuts its ``raw`` text at ``max_bytes``; ``whole`` adds the
    uncut payload as the binary column ``payload`` (Parquet DLQ).
    """
    return bad.select(
        F.concat_ws(":", F.col("topic"), F.col("partition").cast("string")).alias("key"),
        F.to_json(F.struct(
            F.lit(SCHEMA_VERSION).alias("schema_version"),
            F.lit(source).alias("source"),
            F.col("error").alias("error"),
            dlq_raw(F.col(value_col), max_bytes).alias("raw"),
        )).alias("value"),
        "topic", "partition", "offset",
        *(["timestamp"] if "timestamp" in bad.columns else []),
        *([F.col(value_col).cast("binary").alias("payload")] if whole else []),
    )


def encode_event(df: DataFrame, key_col: str = "symbol") -> DataFrame:
    """trade_v1 rows -> ``key, value`` records (JSON text) for a topic sink.

    NULL fields are written as JSON nulls (a present-but-null key fails
    the contract as a type error, not as a missing key).
    """
    return df.select(
        F.col(key_col).cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in TRADE_V1_REQUIRED]), {"ignoreNullFields": "false"}).alias("value"),
    )


def normalize_feed(raw: DataFrame, text_col: str = "value", source: str = FEED_SOURCE,
                   event_id: Column | None = None, ingested_at: Column | None = None) -> DataFrame:
    """Exchange trade messages -> trade_v1 events.

    ``s,t,T,p,q,m`` -> symbol, trade_id, trade_ts, price (from text),
    qty (from text), is_buyer_maker. ``t``/``T`` differ only by case, so
    the message is read as VARIANT with case-exact paths. ``event_id``
    (default ``uuid()``) and ``ingested_at`` (default: now, ISO-8601 UTC)
    can be injected for reproducible runs.
    """
    v = F.try_parse_json(payload_text(F.col(text_col)))
    return raw.select(
        F.lit(SCHEMA_VERSION).cast("bigint").alias("schema_version"),
        (event_id if event_id is not None else F.expr("uuid()")).alias("event_id"),
        F.lit(source).alias("source"),
        (ingested_at if ingested_at is not None else iso_utc_string(F.current_timestamp())).alias("ingested_at"),
        F.try_variant_get(v, "$.s", "string").alias("symbol"),
        F.try_variant_get(v, "$.t", "bigint").alias("trade_id"),
        F.try_variant_get(v, "$.T", "bigint").alias("trade_ts"),
        F.try_variant_get(v, "$.p", "string").try_cast("double").alias("price"),
        F.try_variant_get(v, "$.q", "string").try_cast("double").alias("qty"),
        F.try_variant_get(v, "$.m", "boolean").alias("is_buyer_maker"),
    )


# Feed keys and the event fields they become.
FEED_KEYS = {"s": "symbol", "t": "trade_id", "T": "trade_ts", "p": "price", "q": "qty", "m": "is_buyer_maker"}


def check_feed(raw: DataFrame, text_col: str = "value", source: str = FEED_SOURCE,
               event_id: Column | None = None, ingested_at: Column | None = None) -> DataFrame:
    """Raw exchange messages -> the message's own columns, the trade_v1 event and
    ``error``.

    One parse. ``error`` is NULL, ``invalid_json``, ``not_object``,
    ``missing_key:<feed key>``, ``type:<event field>`` (null or not
    convertible) or ``range:trade_ts``; the original text stays beside it.
    """
    own = [c for c in raw.columns if c not in TRADE_V1_REQUIRED]
    v = F.col("_v")
    parsed = raw.select(*own, F.try_parse_json(payload_text(F.col(text_col))).alias("_v"))
    keyed = parsed.select("*", *(F.variant_get(v, _path(k), "variant").alias(_fcol(f)) for k, f in FEED_KEYS.items()))
    as_text = lambda f: F.try_variant_get(F.col(_fcol(f)), "$", "string").try_cast("double")
    event = keyed.select(
        *own, "_v", *(_fcol(f) for f in FEED_KEYS.values()),
        F.lit(SCHEMA_VERSION).cast("bigint").alias("schema_version"),
        (event_id if event_id is not None else F.expr("uuid()")).alias("event_id"),
        F.lit(source).alias("source"),
        (ingested_at if ingested_at is not None else iso_utc_string(F.current_timestamp())).alias("ingested_at"),
        F.upper(F.try_variant_get(F.col(_fcol("symbol")), "$", "string")).alias("symbol"),
        F.try_variant_get(F.col(_fcol("trade_id")), "$", "bigint").alias("trade_id"),
        F.try_variant_get(F.col(_fcol("trade_ts")), "$", "bigint").alias("trade_ts"),
        as_text("price").alias("price"),
        as_text("qty").alias("qty"),
        F.try_variant_get(F.col(_fcol("is_buyer_maker")), "$", "boolean").alias("is_buyer_maker"),
    )
    error = F.when(v.isNull(), ERR_INVALID_JSON).when(~F.schema_of_variant(v).startswith("OBJECT"), ERR_NOT_OBJECT)
    for k, f in FEED_KEYS.items():
        error = error.when(F.col(_fcol(f)).isNull(), f"missing_key:{k}")
    for f in FEED_KEYS.values():
        error = error.when(F.col(f).isNull(), f"type:{f}")
    error = error.when(~F.col("trade_ts").between(TRADE_TS_MIN_MS, TRADE_TS_MAX_MS), ERR_RANGE)
    return event.select(*own, *TRADE_V1_REQUIRED, error.alias("error"))


def with_partition_values(df: DataFrame, ts_col: str = "trade_ts") -> DataFrame:
    """Add the lake's partition values (pair, UTC date, hour) from epoch ms."""
    d, h = partition_values(ts_col)
    return df.withColumn("pair", F.upper(F.col("symbol"))).withColumn(
        "trade_date", d.cast("date")
    ).withColumn("hour", h.cast("tinyint"))


def ingest_counts(checked: DataFrame) -> DataFrame:
    """Per (topic, partition): consumed, landed, dead-lettered, next offset.

    ``next_offset`` is what the reference commits (last offset + 1).
    """
    return checked.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("consumed"),
        F.count_if(F.col("error").isNull()).alias("landed"),
        F.count_if(F.col("error").isNotNull()).alias("dead_lettered"),
        (F.max("offset") + 1).alias("next_offset"),
    )
