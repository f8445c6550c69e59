"""Reference-shaped window and join forms, planned without hot tasks.

The reference expresses open/close with two ``ROW_NUMBER`` windows and a
self-join, and latency with whole-partition window aggregates followed
by ``DISTINCT``. A Spark ``Window.partitionBy(pair, minute)`` sends every
row of a group to one task, so a hot group would be processed by a
single task. These helpers give the same results with aggregates
(partial + final) and a join back on the group keys; AQE's skew-join
splits an oversized join partition at runtime.

``first_last`` and ``distinct_over_group`` give what such SQL reduces its
windows to (one row per group) in one aggregate, without the join back.

They exist for users porting window-shaped SQL; the marts themselves use
single aggregates (``operators.marts``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_last_flags(df: DataFrame, keys: Sequence[str], order_key: Column,
                     first: str = "is_first", last: str = "is_last") -> DataFrame:
    """Flag the earliest/latest row per group (``ROW_NUMBER() = 1`` asc/desc).

    ``order_key`` must be hash-aggregable and unique within a group for
    the flags to mark exactly one row (ties are all flagged).
    """
    keyed = df.withColumn("_ok", order_key)
    ext = keyed.groupBy(*keys).agg(F.min("_ok").alias("_ok_min"), F.max("_ok").alias("_ok_max"))
    return (
        keyed.join(ext, list(keys), "inner")
        .withColumn(first, F.col("_ok") == F.col("_ok_min"))
        .withColumn(last, F.col("_ok") == F.col("_ok_max"))
        .drop("_ok", "_ok_min", "_ok_max")
    )


def first_last_values(flagged: DataFrame, keys: Sequence[str], value: str,
                      first_alias: str, last_alias: str,
                      first: str = "is_first", last: str = "is_last") -> DataFrame:
    """``MIN(CASE WHEN rn_asc = 1 THEN v END)`` / same for ``rn_desc``."""
    return flagged.groupBy(*keys).agg(
        F.min(F.when(F.col(first), F.col(value))).alias(first_alias),
        F.min(F.when(F.col(last), F.col(value))).alias(last_alias),
    )


def first_last(df: DataFrame, keys: Sequence[str], order_key: Column, value: str,
               first_alias: str, last_alias: str) -> DataFrame:
    """``value`` of the row with ``ROW_NUMBER() = 1`` per group, ascending and
    descending by ``order_key``, in one aggregate. As with ROW_NUMBER one row is
    taken among ties; rows without a key come after all others."""
    keyed = df.select(*keys, F.col(value).alias("_value"), order_key.alias("_ok"))
    any_row = F.any_value("_value")
    return keyed.groupBy(*keys).agg(
        F.when(F.count("_ok") > 0, F.min_by("_value", "_ok")).otherwise(any_row).alias(first_alias),
        F.when(F.count("_ok") > 0, F.max_by("_value", "_ok")).otherwise(any_row).alias(last_alias),
    )


def distinct_over_group(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """``SELECT DISTINCT keys, agg(...) OVER (PARTITION BY keys)``: one row per group."""
    return df.groupBy(*keys).agg(*aggs)


def over_group(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """``agg(...) OVER (PARTITION BY keys)`` attached to every row.

    Computed as a grouped aggregate joined back on the keys (the named
    window ``WINDOW w AS (PARTITION BY ...)`` is just ``keys`` here).
    """
    per_group = df.groupBy(*keys).agg(*aggs)
    return df.join(per_group, list(keys), "inner")


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on several key columns (one row per key on each side here)."""
    return left.join(right, list(keys), how)
