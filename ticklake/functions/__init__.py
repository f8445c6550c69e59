"""Scalar expression helpers (built-in Catalyst expressions only)."""

from ticklake.functions.time import (
    bucket_start,
    epoch_ms_to_ts,
    epoch_ms_to_ts_seconds,
    iso_to_ts,
    iso_utc_string,
    lookback_start,
    minute_bucket,
    partition_values,
    seconds_between,
    trade_date,
    trade_hour,
)
from ticklake.functions.util import as_col, nullif_zero, safe_ratio, sum_if, trade_order_key

__all__ = [
    "as_col",
    "bucket_start",
    "epoch_ms_to_ts",
    "epoch_ms_to_ts_seconds",
    "iso_to_ts",
    "iso_utc_string",
    "lookback_start",
    "minute_bucket",
    "nullif_zero",
    "partition_values",
    "safe_ratio",
    "seconds_between",
    "sum_if",
    "trade_date",
    "trade_hour",
    "trade_order_key",
]
