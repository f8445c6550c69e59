"""Continuous marts: watermarked minute buckets, dedupe, rolling activity.

The batch definitions are reused unchanged; streaming only swaps the
bucket for an event-time ``window`` so the watermark can close minutes
and evict their state. The watermark is the caller's choice and has no
default: trades later than it are dropped by the aggregate, so ``late_rows``
keeps them aside and ``reconcile_minutes`` rebuilds their dates in the
stream's own table.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ticklake.operators import marts as M
from ticklake.operators.staging import earliest, stg_trades
from ticklake.sources import files
from ticklake.sources.lake import matches
from ticklake.streaming.sources import apply_trigger

BUCKET = "1 minute"
# The health look-back and the refresh cadence of the marts.
ROLLING_WINDOW = "5 minutes"
ROLLING_SLIDE = "1 minute"
REFRESH_INTERVAL = "5 minutes"
MINUTE_KEYS = ("pair", "minute_bucket")
COUNT_KEYS = (*MINUTE_KEYS, "_lat")
TRADE_KEYS = ("trade_key", "trade_ts_utc")
# A versioned table with more versions than this folds the older ones.
FOLD_VERSIONS = 24


def stream_stg(trades: DataFrame) -> DataFrame:
    """Staging over a trade_v1 stream (a projection: works on streams as is)."""
    return stg_trades(trades)


def minute_stats_stream(stg: DataFrame, groups, watermark: str) -> DataFrame:
    """Per (pair, minute) measures with a watermark on ``trade_ts_utc``."""
    w = stg.withWatermark("trade_ts_utc", watermark)
    return M.minute_stats(w, groups, bucket=F.window("trade_ts_utc", BUCKET))


def stream_minute_marts(stg: DataFrame, watermark: str) -> DataFrame:
    """All four minute marts side by side from ONE streaming aggregation
    (``marts.WIDE_MINUTE_COLUMNS``)."""
    return M.wide_from_stats(minute_stats_stream(stg, M.ALL_MINUTE, watermark))


def write_stream(df: DataFrame, path: str, checkpoint: str, trigger: str | None = REFRESH_INTERVAL,
                 available_now: bool = False, partition_by: Iterable[str] = ()) -> DataStreamWriter:
    """Append-mode Parquet file sink (exactly-once via its metadata log)."""
    w = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if partition_by:
        w = w.partitionBy(*partition_by)
    return apply_trigger(w, trigger, available_now)


def dedupe_stream(stg: DataFrame, watermark: str, keys=("symbol", "trade_id")) -> DataFrame:
    """Drop re-delivered trades; state for a key lives until the watermark
    passes its first event time plus the delay. Trades that arrive later than
    ``watermark`` behind the newest one are dropped, too: choose it above
    the feed's disorder, and keep ``late_rows`` beside it."""
    return stg.withWatermark("trade_ts_utc", watermark).dropDuplicatesWithinWatermark(list(keys))


def dedupe_updates(stg: DataFrame, watermark: str) -> DataFrame:
    """One row per trade with the batch rule of ``staging.dedupe_trades``: the
    earliest ingest, whatever arrived first.

    An aggregate in update mode: a copy with an earlier ingest that arrives later
    replaces the row. State is one row per trade until ``watermark`` passes its
    trade time. Keep it with ``write_versions(..., keys=TRADE_KEYS)``.
    """
    return earliest(stg.withWatermark("trade_ts_utc", watermark), list(TRADE_KEYS))


def _slice(window: str, slide: str) -> str:
    """The widest tumbling window of which ``window`` and ``slide`` are multiples."""
    widths = [pd.Timedelta(x) // pd.Timedelta("1us") for x in (window, slide)]
    return f"{math.gcd(*widths)} microseconds"


def rolling_activity(stg: DataFrame, window: str = ROLLING_WINDOW, slide: str = ROLLING_SLIDE,
                     watermark: str | None = None) -> DataFrame:
    """Trades per pair in every ``window`` sliding by ``slide`` (batch or stream).

    Trades are counted per slice of time first and the slices' counts added to
    the windows they lie in, so the fan-out (five windows here) meets one row per
    pair and slice, not every trade. As a stream (append mode, ``watermark``
    given) both levels keep one row per pair and open slice or window;
    ``rolling_from_minutes`` serves windows that are still open.
    """
    src = stg.withWatermark("trade_ts_utc", watermark) if watermark else stg
    slices = src.groupBy("pair", F.window("trade_ts_utc", _slice(window, slide)).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    return _windows(slices, F.window("s", window, slide), "n")


def rolling_from_minutes(minutes: DataFrame, window: str = ROLLING_WINDOW, slide: str = ROLLING_SLIDE) -> DataFrame:
    """``rolling_activity`` from a table of minutes (``read_minute_table``, a minute
    mart): open windows included, whole minutes as widths."""
    if pd.Timedelta(_slice(window, slide)) % pd.Timedelta(BUCKET):
        raise ValueError(f"{window} sliding by {slide} cuts minutes")
    return _windows(minutes, F.window("minute_bucket", window, slide), "trade_count")


def _windows(counts: DataFrame, window: Column, n: str) -> DataFrame:
    out = counts.groupBy("pair", window.alias("w")).agg(F.sum(n).alias("trade_count"))
    return out.select(
        "pair", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "trade_count"
    )


# Versions of reconciled minutes lie above every micro-batch number.
_RECONCILED = 1 << 40


def write_minute_table(wide: DataFrame, root: str, checkpoint: str, trigger: str | None = REFRESH_INTERVAL,
                       available_now: bool = False) -> StreamingQuery:
    """Keep the wide minute table of ``stream_minute_marts`` under ``root``, open
    minutes included (``write_versions``)."""
    return write_versions(wide, root, checkpoint, MINUTE_KEYS, trigger, available_now)


def write_versions(df: DataFrame, root: str, checkpoint: str, keys: Iterable[str],
                   trigger: str | None = REFRESH_INTERVAL, available_now: bool = False) -> StreamingQuery:
    """Keep an updating stream as a table with one row per ``keys``.

    Update mode: every batch writes the rows it changed as ``version=<batch_id>``
    (replaced when a batch is replayed); ``read_versions`` takes the newest of
    each key. Versions of earlier batches are folded into one when there are
    over ``FOLD_VERSIONS``, so folders stay few and rows near one per key.
    """
    base, keys = root.rstrip("/"), list(keys)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        files.recover(spark, base)
        batch.write.mode("overwrite").parquet(f"{base}/version={batch_id}")
        fold_versions(spark, base, keys, 0, batch_id)

    return apply_trigger(df.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint),
                         trigger, available_now).start()


def fold_versions(spark: SparkSession, root: str, keys: Iterable[str], first: int, below: int, most: int | None = None,
                  merge=None) -> int:
    """Merge the versions in [first, below) into the newest of them if they are over
    ``most`` (``FOLD_VERSIONS``), keeping the newest row of each key, or what
    ``merge`` makes of the rows."""
    base, most = root.rstrip("/"), FOLD_VERSIONS if most is None else most
    version = F.regexp_extract("path", "/version=([0-9]+)/", 1).cast("long").alias("version")
    found = files.file_rows(spark, base).select("path", version).where(F.col("version").between(first, below - 1)).collect()
    versions = {r.version for r in found}
    if len(versions) <= most:
        return 0
    paths = [r.path for r in found]  # file names; bounded by the versions kept
    rows = spark.read.option("basePath", base).parquet(*paths)
    merged = merge(rows) if merge else _newest(rows, keys)
    return files.replace(spark, base, paths, merged, f"{base}/version={max(versions)}")


def stream_minute_counts(stg: DataFrame, watermark: str) -> DataFrame:
    """All four minute marts as partials per (pair, minute, second of latency).

    The state of ``stream_minute_marts`` holds every latency of an open minute
    for its exact percentiles; here each state row is a fixed set of numbers in a
    hash aggregate. Keep it with ``write_minute_counts``.
    """
    return M.latency_counts(stg.withWatermark("trade_ts_utc", watermark), bucket=F.window("trade_ts_utc", BUCKET))


def write_minute_counts(counts: DataFrame, root: str, checkpoint: str, trigger: str | None = REFRESH_INTERVAL,
                        available_now: bool = False) -> StreamingQuery:
    """Keep ``stream_minute_counts`` under ``root`` (``write_versions``)."""
    return write_versions(counts, root, checkpoint, COUNT_KEYS, trigger, available_now)


def read_minute_counts(spark: SparkSession, root: str) -> DataFrame:
    """The wide minute table (as ``read_minute_table``) of a table of
    ``write_minute_counts``, its percentiles taken on read."""
    return M.wide_from_stats(M.merge_counts(read_versions(spark, root, COUNT_KEYS)))


def read_minute_table(spark: SparkSession, root: str) -> DataFrame:
    """The newest version of every (pair, minute) of a streamed minute table."""
    return read_versions(spark, root, MINUTE_KEYS)


def read_versions(spark: SparkSession, root: str, keys: Iterable[str]) -> DataFrame:
    """The newest row of every key of a table of ``write_versions``."""
    return _newest(spark.read.parquet(root), keys)


def _newest(rows: DataFrame, keys: Iterable[str]) -> DataFrame:
    keys = list(keys)
    cols = [c for c in rows.columns if c not in (*keys, "version")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*cols), "version").alias("r"))
    return newest.select(*(c if c in keys else F.col(f"r.{c}") for c in rows.columns if c != "version"))


def reconcile_minutes(stg: DataFrame, root: str, dates: Iterable) -> None:
    """Rebuild the minutes of ``dates`` in a streamed minute table from all landed
    trades (late ones included). Pass ``stg`` over the lake: the filter on
    its ``trade_date`` directories reads only those dates."""
    ds = [F.lit(str(d)).cast("date") for d in dates]
    spark, base = stg.sparkSession, root.rstrip("/")
    known = spark.read.parquet(base).agg(F.max("version")).first()[0]
    version = max(int(known or 0), _RECONCILED - 1) + 1
    wide = M.wide_from_stats(M.minute_stats(stg.where(F.col("trade_date").isin(*ds)), M.ALL_MINUTE))
    wide.write.mode("overwrite").parquet(f"{base}/version={version}")
    fold_versions(spark, base, MINUTE_KEYS, _RECONCILED, version)


def late_rows(stg: DataFrame, root: str, checkpoint: str, watermark: str, trigger: str | None = REFRESH_INTERVAL,
              available_now: bool = False) -> StreamingQuery:
    """Side output: staging rows whose minute was closed when they arrived.

    Per batch, the newest trade time of all earlier batches less
    ``watermark`` is the watermark that applies; rows whose minute ends at or
    before it go to ``root/late/batch=<id>``. The newest time so far lies in
    ``root/newest/batch=<id>`` of the last two batches, so a restart or a
    replay of the last batch finds it.
    """
    base = root.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            batch.where(_late(batch, base, batch_id, watermark)).write.mode("overwrite").parquet(f"{base}/late/batch={batch_id}")
            _note_newest(batch, base, batch_id)
        finally:
            batch.unpersist()

    w = stg.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return apply_trigger(w, trigger, available_now).start()


def _seen(spark: SparkSession, base: str, batch_id: int) -> Column:
    """The newest trade time of the batches before ``batch_id``; null before the first."""
    seen, at = None, f"{base}/newest/batch={batch_id - 1}"
    if matches(spark, at):
        # the newest time travels as text: no zone between driver and executors
        seen = spark.read.parquet(at).select(F.col("newest").cast("string")).first()[0]
    return F.lit(seen).cast("timestamp")


def _late(batch: DataFrame, base: str, batch_id: int, watermark: str) -> Column:
    ends = F.date_trunc("minute", "trade_ts_utc") + F.expr(f"INTERVAL {BUCKET}")
    line = _seen(batch.sparkSession, base, batch_id) - F.expr(f"INTERVAL {watermark}")
    return F.coalesce(ends <= line, F.lit(False))


def _note_newest(batch: DataFrame, base: str, batch_id: int) -> None:
    spark = batch.sparkSession
    newest = batch.agg(F.greatest(F.max("trade_ts_utc"), _seen(spark, base, batch_id)).alias("newest"))
    newest.write.mode("overwrite").parquet(f"{base}/newest/batch={batch_id}")
    files.remove(spark, f"{base}/newest/batch={batch_id - 2}")


def split_late(stg: DataFrame, root: str, side: str, checkpoint: str, watermark: str, trigger: str | None = REFRESH_INTERVAL,
               available_now: bool = False) -> StreamingQuery:
    """Minute partials of the trades in time under ``root``, late ones under
    ``side/late``, from one query.

    Every row of a batch goes to exactly one of the two by one watermark, whatever
    the order of files and the cut of batches (two queries, ``late_rows`` beside an
    aggregate, each keep a watermark of their own). A batch adds its partials as
    ``version=<batch_id>`` (replaced when it is replayed); there is no state
    besides the newest trade time. ``read_split`` reads both.
    """
    base, side = root.rstrip("/"), side.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        files.recover(spark, base)
        batch = batch.persist()
        try:
            late = _late(batch, side, batch_id, watermark)
            M.latency_counts(batch.where(~late)).write.mode("overwrite").parquet(f"{base}/version={batch_id}")
            batch.where(late).write.mode("overwrite").parquet(f"{side}/late/batch={batch_id}")
            _note_newest(batch, side, batch_id)
        finally:
            batch.unpersist()
        fold_versions(spark, base, COUNT_KEYS, 0, batch_id, merge=M.fold_counts)

    w = stg.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return apply_trigger(w, trigger, available_now).start()


def read_split(spark: SparkSession, root: str, side: str | None = None) -> DataFrame:
    """The wide minute table of ``split_late``; with ``side`` the late trades are in it:
    their partials add to the stored ones, so no landed trade is read again."""
    counts = spark.read.parquet(root).drop("version")
    if side is not None:
        late = spark.read.parquet(f"{side.rstrip('/')}/late").drop("batch")
        counts = counts.unionByName(M.latency_counts(late))
    return M.wide_from_stats(M.merge_counts(counts))


def scheduled_refresh(trades_stream: DataFrame, lake_root: str, root: str, checkpoint: str,
                      interval: str = REFRESH_INTERVAL, available_now: bool = False,
                      db: str | None = None, dedupe: bool = False):
    """Every ``interval``: incrementally refresh the dates touched by new trades.

    A ``foreachBatch`` over the landed trade stream: each micro-batch
    finds its distinct trade dates (a handful of values) and runs
    ``jobs.refresh_dates`` for them — those dates' minute marts are
    rebuilt from the lake (late trades included) and the health report
    is merged. Re-running a batch rewrites the same partitions.
    """
    from ticklake.plans.jobs import refresh_dates

    def _batch(batch: DataFrame, batch_id: int) -> None:
        dates = [r[0] for r in stg_trades(batch).select("trade_date").distinct().collect()]
        if dates:
            refresh_dates(batch.sparkSession, lake_root, root, dates, db=db, dedupe=dedupe)

    w = trades_stream.writeStream.foreachBatch(_batch).option("checkpointLocation", checkpoint)
    return apply_trigger(w, interval, available_now)


def scheduled_merge(trades_stream: DataFrame, partials_root: str, root: str, checkpoint: str,
                    interval: str = REFRESH_INTERVAL, available_now: bool = False, db: str | None = None, as_of=None):
    """Every ``interval``: add the new trades' partials and merge the marts that they
    touch (``partials.refresh_merged``); no landed trade is read again. For a
    lake whose re-deliveries must count once use ``scheduled_refresh``."""
    from ticklake.plans.partials import refresh_merged

    w = trades_stream.writeStream.foreachBatch(
        lambda batch, batch_id: refresh_merged(batch, partials_root, root, batch_id, as_of=as_of, db=db) and None
    ).option("checkpointLocation", checkpoint)
    return apply_trigger(w, interval, available_now)


def rows_dropped_by_watermark(query) -> int:
    """Late rows a stateful query discarded (sum over its recent progress).

    These trades are not lost: they are in the lake and the next
    ``refresh_dates`` for their date includes them.
    """
    total = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else p.stateOperators:
            total += (op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict)
                      else op.numRowsDroppedByWatermark)
    return total
