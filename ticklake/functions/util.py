"""Small column helpers."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def nullif_zero(c) -> Column:
    """``NULLIF(x, 0)`` — turns a zero divisor into NULL (ANSI mode raises)."""
    c = as_col(c)
    return F.when(c != 0, c)


def safe_ratio(num, den) -> Column:
    """``num / NULLIF(den, 0)``."""
    return as_col(num) / nullif_zero(den)


def sum_if(cond: Column, value) -> Column:
    """``SUM(CASE WHEN cond THEN value ELSE 0 END)``.

    A NULL condition falls to the ELSE branch, so rows with an unknown
    flag count in totals only; a group with no match sums to 0, not NULL.
    """
    v = F.lit(value) if isinstance(value, (int, float)) else as_col(value)
    return F.sum(F.when(cond, v).otherwise(F.lit(0)))


def trade_order_key(ts_ms, trade_id) -> Column:
    """Single DECIMAL(38,0) key ordering rows by (trade_ts ms, trade_id).

    ``ts * 10^20 + (id + 2^63)`` is strictly monotone in the pair for any
    signed 64-bit id and |ts| < 10^17 ms, so ``min_by``/``max_by`` on it
    equal ordering by the struct — but a decimal buffer keeps the plan a
    HashAggregate (a struct key forces a sort-based aggregate).
    """
    ts = as_col(ts_ms).cast("decimal(17,0)")
    tid = as_col(trade_id).cast("decimal(20,0)") + F.lit(Decimal(2**63)).cast("decimal(20,0)")
    key = ts * F.lit(Decimal(10**20)).cast("decimal(21,0)") + tid
    return key.cast("decimal(38,0)")
