"""Data-quality checks: not-null rules, key uniqueness, DLQ rate.

Each check is one aggregate pass over its table (partial aggregation,
no per-row data leaves the executors). Results are tidy rows
``(table_name, column_name, check_name, failures)``; the nightly job
fails when any ``failures > 0``. Only that small result is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.functions.time import iso_to_ts
from ticklake.schema import NOT_NULL_RULES

CHECK_COLUMNS = ("table_name", "column_name", "check_name", "failures")


class QualityCheckFailed(RuntimeError):
    pass


def not_null(df: DataFrame, table: str, cols: Sequence[str]) -> DataFrame:
    """NULL count per column, all columns in one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("failures")) for c in cols
    ])).alias("_s")
    return counts.select(stacked).select(
        F.lit(table).alias("table_name"),
        F.col("_s.column_name").alias("column_name"),
        F.lit("not_null").alias("check_name"),
        F.col("_s.failures").cast("bigint").alias("failures"),
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys seen more than once, with their counts."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def unique(df: DataFrame, table: str, key: str) -> DataFrame:
    """Number of key values that occur more than once."""
    return duplicate_keys(df, key).agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(table).alias("table_name"),
        F.lit(key).alias("column_name"),
        F.lit("unique").alias("check_name"),
        F.col("failures").cast("bigint"),
    )


def run_checks(tables: Mapping[str, DataFrame], rules: Mapping[str, Sequence[str]] = NOT_NULL_RULES,
               unique_keys: Mapping[str, str] | None = None) -> DataFrame:
    """All not-null rules (plus optional uniqueness) for the given tables."""
    parts = [not_null(tables[t], t, cols) for t, cols in rules.items() if t in tables]
    for t, key in (unique_keys or {}).items():
        if t in tables:
            parts.append(unique(tables[t], t, key))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def assert_passed(checks: DataFrame) -> list[tuple]:
    """Raise when any check has failures; returns the failing rows."""
    failing = [tuple(r) for r in checks.where(F.col("failures") > 0).collect()]
    if failing:
        raise QualityCheckFailed(f"{len(failing)} data-quality checks failed: {failing}")
    return failing


def dlq_rate(landed: DataFrame, dlq: DataFrame, landed_ts: str = "ingested_at_utc",
             dlq_ts: str = "timestamp", interval: str = "1 hour") -> DataFrame:
    """Landed vs dead-lettered records per ``interval`` (epoch-aligned).

    Both sides are reduced to (interval, 1/0 flags) and summed in one
    aggregate — partial sums map-side, one small shuffle.
    """
    good = landed.select(F.window(landed_ts, interval).getField("start").alias("interval_start"),
                         F.lit(1).alias("good"), F.lit(0).alias("bad"))
    bad = dlq.select(F.window(dlq_ts, interval).getField("start").alias("interval_start"),
                     F.lit(0).alias("good"), F.lit(1).alias("bad"))
    return good.unionByName(bad).groupBy("interval_start").agg(
        F.sum("good").cast("bigint").alias("landed"),
        F.sum("bad").cast("bigint").alias("dead_lettered"),
    ).withColumn(
        "dlq_rate", F.col("dead_lettered") / (F.col("landed") + F.col("dead_lettered"))
    )


def dlq_rate_of(checked: DataFrame, interval: str = "1 hour") -> DataFrame:
    """``dlq_rate`` straight from checked records (``ingest.check_contract``): one
    scan, one parse, one aggregate.

    A good record counts at its ingest time, a dead letter at its record time; a
    record without that time is in no interval.
    """
    good = F.col("error").isNull()
    at = F.when(good, iso_to_ts(F.col("ingested_at").cast("string"))).otherwise(F.col("timestamp"))
    counted = checked.select(good.alias("good"), F.window(at, interval).getField("start").alias("interval_start"))
    out = counted.groupBy("interval_start").agg(
        F.count_if("good").alias("landed"),
        F.count_if(~F.col("good")).alias("dead_lettered"),
    )
    return out.withColumn("dlq_rate", F.col("dead_lettered") / (F.col("landed") + F.col("dead_lettered")))
