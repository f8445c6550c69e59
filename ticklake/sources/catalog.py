"""Catalog helpers: namespaces, views, table lookup.

Three namespaces mirror the layers: ``ext`` (raw external table over
the lake), ``stg`` (staging view) and ``marts``. Works with the
session's catalog (in-memory by default, Hive/Unity-style when the
deployment configures one).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ticklake.schema import TRADE_TS_MAX_MS

NAMESPACES = ("ext", "stg", "marts")


def ensure_namespaces(spark: SparkSession, names: Iterable[str] = NAMESPACES,
                      location_root: str | None = None) -> list[str]:
    """``CREATE DATABASE IF NOT EXISTS`` for each name (idempotent).

    ``location_root`` places managed tables under a shared folder instead
    of the session's warehouse directory.
    """
    made = []
    for n in names:
        loc = f" LOCATION '{location_root.rstrip('/')}/{n}.db'" if location_root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{n}`{loc}")
        made.append(n)
    return made


def create_view(df: DataFrame, name: str, db: str | None = None) -> str:
    """Register a staging view.

    A session-scoped temp view (the default) works for any DataFrame; a
    catalog view needs SQL text, so for ``db`` we register a global temp
    view (``global_temp.name``) visible to every session of the app.
    """
    if db is None:
        df.createOrReplaceTempView(name)
        return name
    df.createOrReplaceGlobalTempView(name)
    return f"global_temp.{name}"


# The staging projection (``operators.staging.stg_trades`` over the keyed lake) as SQL.
_STAGING_SQL = f"""
SELECT pair, trade_date, hour, symbol, trade_id, trade_ts_utc, price, qty, is_buyer_maker, ingested_at_utc, event_id,
       schema_version, source, concat(symbol, ':', cast(trade_id AS string)) AS trade_key
FROM (
  SELECT *, timestamp_seconds((CASE WHEN trade_ts BETWEEN -{TRADE_TS_MAX_MS} AND {TRADE_TS_MAX_MS} THEN trade_ts END) div 1000) AS trade_ts_utc
  FROM (
    SELECT pair, trade_date, hour, symbol, cast(trade_id AS bigint) AS trade_id, cast(trade_ts AS bigint) AS trade_ts,
           cast(price AS double) AS price, cast(qty AS double) AS qty, cast(is_buyer_maker AS tinyint) AS is_buyer_maker,
           try_cast(cast(ingested_at AS string) AS timestamp) AS ingested_at_utc, cast(event_id AS string) AS event_id,
           cast(schema_version AS int) AS schema_version, cast(source AS string) AS source
    FROM {{table}}
  )
)
WHERE trade_ts_utc IS NOT NULL
"""


def create_staging_view(spark: SparkSession, table: str = "ext.trades", name: str = "stg.stg_trades") -> str:
    """(Re)create the persistent staging view over an external trades table.

    It lives in the catalog: any session reads it by name, and filters on its
    columns prune the table's partitions. Columns as published (no ordering
    column); for the marts use ``staging.stg_trades``.
    """
    db = name.rsplit(".", 1)[0]
    if not spark.catalog.databaseExists(db):
        ensure_namespaces(spark, [db])
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {_STAGING_SQL.format(table=table)}")
    return name


def table_exists(spark: SparkSession, db: str, table: str) -> bool:
    return spark.catalog.tableExists(f"{db}.{table}")


def list_tables(spark: SparkSession, db: str) -> list[tuple[str, str]]:
    """(name, tableType) of every object in ``db``."""
    return [(t.name, t.tableType) for t in spark.catalog.listTables(db)]
