"""Time expressions (all UTC, all Catalyst built-ins).

The session time zone must be UTC (``ticklake.session.configure``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticklake.functions.util import as_col
from ticklake.schema import TRADE_TS_MAX_MS


def _sane(ms) -> Column:
    """Epoch ms as BIGINT; NULL beyond year 9999 either way, so that a value in
    the wrong unit (ns, µs) becomes a missing time instead of an overflow."""
    ms = as_col(ms).cast("long")
    return F.when(ms.between(-TRADE_TS_MAX_MS, TRADE_TS_MAX_MS), ms)


def epoch_ms_to_ts_seconds(ms) -> Column:
    """Epoch ms -> TIMESTAMP at whole-second precision.

    Integer division truncates toward zero, then seconds are added to
    1970-01-01 (milliseconds are dropped, as in the staging contract).
    """
    return F.timestamp_seconds(F.call_function("div", _sane(ms), F.lit(1000)))


def epoch_ms_to_ts(ms) -> Column:
    """Epoch ms -> TIMESTAMP keeping milliseconds."""
    return F.timestamp_millis(_sane(ms))


def iso_to_ts(text) -> Column:
    """ISO-8601 text -> TIMESTAMP (µs); offset and fraction optional.

    ``T`` or space separator, ``Z``/``+hh:mm`` suffix or none; anything
    unparseable becomes NULL instead of failing the job.
    """
    return as_col(text).try_cast("timestamp")


def minute_bucket(ts) -> Column:
    """Truncate to the minute (``date_trunc``; ``trunc(ts,'MI')`` is NULL)."""
    return F.date_trunc("minute", as_col(ts))


def bucket_start(ts, bucket: str = "1 minute") -> Column:
    """Start of the tumbling bucket containing ``ts`` (epoch-aligned)."""
    if bucket.strip().lower() in ("1 minute", "minute"):
        return minute_bucket(ts)
    return F.window(as_col(ts), bucket).getField("start")


def seconds_between(start, end) -> Column:
    """Whole seconds from ``start`` to ``end``, truncated toward zero.

    Negative differences are kept (ingest clocks can run behind).
    """
    return F.timestamp_diff("SECOND", as_col(start), as_col(end))


def trade_date(ts) -> Column:
    return F.to_date(as_col(ts))


def trade_hour(ts) -> Column:
    """Hour of day as TINYINT."""
    return F.hour(as_col(ts)).cast("tinyint")


def partition_values(ms) -> tuple[Column, Column]:
    """Epoch ms -> (``yyyy-MM-dd``, ``HH``) strings in UTC (lake naming)."""
    ts = epoch_ms_to_ts(ms)
    return F.date_format(ts, "yyyy-MM-dd"), F.date_format(ts, "HH")


def iso_utc_string(ts) -> Column:
    """TIMESTAMP -> ISO-8601 text with µs and ``+00:00`` offset."""
    return F.date_format(as_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def lookback_start(as_of, minutes) -> Column:
    """``as_of - minutes`` (the lower bound of a serving slice)."""
    return as_col(as_of) - F.make_interval(mins=F.lit(int(minutes)))
