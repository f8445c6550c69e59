"""Typed staging layer over raw trade events (``stg_trades``) and dedupe.

One projection, no shuffle: casts, derived partition columns, the
``pair:trade_id`` key and a not-null filter on the trade time. Column
pruning and the filter are pushed into the Parquet scan by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.functions.time import (
    epoch_ms_to_ts_seconds,
    iso_to_ts,
    trade_date,
    trade_hour,
)
from ticklake.schema import LAKE_PARTITION_COLS, STG_COLUMNS, STG_ORDER_COL


def stg_trades(raw: DataFrame) -> DataFrame:
    """trade_v1 rows -> staging rows (contract columns + ``trade_ts_ms``).

    * ``trade_ts_utc``: epoch ms truncated to whole seconds (TIMESTAMP)
    * ``ingested_at_utc``: ISO text parsed to µs; junk -> NULL
    * ``is_buyer_maker``: boolean -> TINYINT 0/1 (NULL stays NULL)
    * rows whose trade time is NULL (or in another unit than ms) are dropped
    * ``pair`` is the upper-cased symbol. Rows of the lake bring ``pair``,
      ``trade_date`` and ``hour`` as directory keys; these are passed
      through, so that filters on staging prune the lake's directories.
    """
    ts = epoch_ms_to_ts_seconds("trade_ts")
    keyed = set(LAKE_PARTITION_COLS) <= set(raw.columns)
    parsed = raw.select(
        *(F.col(c).alias(f"_{c}") for c in LAKE_PARTITION_COLS if keyed),
        F.col("symbol"),
        F.col("trade_id").cast("bigint").alias("trade_id"),
        F.col("price").cast("double").alias("price"),
        F.col("qty").cast("double").alias("qty"),
        F.col("is_buyer_maker").cast("tinyint").alias("is_buyer_maker"),
        iso_to_ts(F.col("ingested_at").cast("string")).alias("ingested_at_utc"),
        F.col("event_id").cast("string").alias("event_id"),
        F.col("schema_version").cast("int").alias("schema_version"),
        F.col("source").cast("string").alias("source"),
        ts.alias("trade_ts_utc"),
        F.col("trade_ts").cast("bigint").alias(STG_ORDER_COL),
    ).where(F.col("trade_ts_utc").isNotNull())
    return parsed.select(
        (F.col("_pair") if keyed else F.upper("symbol")).alias("pair"),
        (F.col("_trade_date") if keyed else trade_date("trade_ts_utc")).alias("trade_date"),
        (F.col("_hour") if keyed else trade_hour("trade_ts_utc")).alias("hour"),
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
        F.concat(F.col("symbol"), F.lit(":"), F.col("trade_id").cast("string")).alias("trade_key"),
        STG_ORDER_COL,
    )


def contract_columns(stg: DataFrame) -> DataFrame:
    """The published staging columns only (drops the ordering column)."""
    return stg.select(*STG_COLUMNS)


def dedupe_trades(stg: DataFrame, key: str = "trade_key") -> DataFrame:
    """Keep one row per trade key: the earliest ingest (then lowest event_id).

    Delivery is at-least-once, so the same trade can land twice. This is
    an aggregate, not a window: ``min_by`` is combined map-side, so a key
    that is re-delivered millions of times never lands whole in one
    task. Rows with NULL ingest time rank after timed ones.
    """
    return earliest(stg, [key])


def earliest(stg: DataFrame, keys: list[str]) -> DataFrame:
    """The row of the earliest ingest (then lowest event_id) per ``keys``; batch or,
    with the event time among the keys, stream."""
    cols = [c for c in stg.columns if c not in keys]
    order = F.struct(
        F.col("ingested_at_utc").isNull().alias("_late"),
        F.col("ingested_at_utc").alias("_ing"),
        F.col("event_id").alias("_eid"),
    )
    picked = stg.groupBy(*keys).agg(
        F.min_by(F.struct(*[F.col(c) for c in cols]), order).alias("_row")
    )
    return picked.select(*[
        (F.col(c) if c in keys else F.col(f"_row.{c}")).alias(c) for c in stg.columns
    ])
