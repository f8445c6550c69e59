"""Registered queries that chain whole jobs: land, compact, catalog, publish.

Each works on all trades of the test tables and returns what the job's
readers see. Helpers write fixtures to fresh folders under the shared
checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.operators import ingest, serving
from ticklake.operators.staging import stg_trades
from ticklake.plans import jobs
from ticklake.plans.boundary import stable
from ticklake.plans.refresh import read_mart
from ticklake.schema import LAKE_PARTITION_COLS, MART_COLUMNS, TRADE_V1, TRADE_V1_REQUIRED
from ticklake.session import configure, scratch_path
from ticklake.sources.catalog import create_staging_view
from ticklake.sources.files import file_rows
from ticklake.sources.lake import create_external_table, partition_dir, matches, read_lake, read_trades, write_lake
from ticklake.sources.testdata import (
    BASE_MS, feed_messages, kafka_records, load_trades, read_table, trades_from_events, with_redelivery,
)

AS_OF = "2024-01-01 01:10:00"
RANGE_START = "2024-01-01 00:30:00"
RANGE_END = "2024-01-01 00:45:00"
SLICE_PAIR = "CLICK"
CUT_MS = BASE_MS + 48 * 60_000
DAY_MS = 86_400_000
BATCHES = 4


def _lake_cols(df: DataFrame) -> DataFrame:
    return df.select(*TRADE_V1_REQUIRED, *LAKE_PARTITION_COLS)


def _dealt(spark, df: DataFrame) -> DataFrame:
    """``df`` dealt evenly, in no order of time, to a task per core for each of BATCHES
    micro-batches, however few row groups it was read from."""
    return df.repartition(BATCHES * spark.sparkContext.defaultParallelism, F.xxhash64(*df.columns))


def _dealt_trades(spark, sf_dir) -> DataFrame:
    """All trades; the raw events are dealt, so that trades (and what is made of them)
    are built on every core and no payload is shuffled."""
    return trades_from_events(_dealt(spark, read_table(spark, sf_dir, "events")))


def _in_files(dealt: DataFrame, spark, name: str) -> tuple[str, int]:
    """``(folder, files of a micro-batch)``: ``dealt`` rows (``_dealt``) as files that
    make BATCHES micro-batches. A batch is several files, for a file of one row group
    is read by one task, whatever the cluster."""
    path = scratch_path(spark, name)
    dealt.write.parquet(path)
    return path, max(1, -(-file_rows(spark, path).count() // BATCHES))


def _land(spark, records: DataFrame, mode: str = ingest.FULL) -> tuple[str, str]:
    """(lake, DLQ) after landing ``records`` (of dealt trades) in BATCHES micro-batches."""
    from ticklake.streaming.landing import land
    from ticklake.streaming.sources import file_source

    configure(spark)
    src, batch_files = _in_files(records, spark, "records")
    lake, dlq, ck = (scratch_path(spark, n) for n in ("lake", "dlq", "land-ck"))
    land(file_source(spark, src, batch_files), lake, dlq, ck, mode, available_now=True).awaitTermination()
    return lake, dlq


def q_contract_minimal(spark, sf_dir):
    """The five-key contract; null, junk and out-of-range values fail."""
    configure(spark)
    c = ingest.check_contract(kafka_records(load_trades(spark, sf_dir)), ingest.MINIMAL)
    return stable(c.select("offset", "partition", "error", *(
        F.when(F.col("error").isNull(), F.col(k)).alias(k) for k in ("symbol", "trade_id", "trade_ts", "price", "qty")
    )))


def q_stream_land_lake(spark, sf_dir):
    """Damaged records landed in four batches; the lake."""
    lake, _ = _land(spark, kafka_records(_dealt_trades(spark, sf_dir)))
    return stable(_lake_cols(read_lake(spark, lake)))


def q_land_crash_replay(spark, sf_dir):
    """A batch dies after its lake write (its dead letters cannot be written),
    is replayed from the checkpoint, and the lake holds every event once."""
    from pyspark.errors import StreamingQueryException

    from ticklake.streaming.landing import land
    from ticklake.streaming.sources import file_source

    configure(spark)
    src, batch_files = _in_files(kafka_records(_dealt_trades(spark, sf_dir)), spark, "records")
    lake, dlq, ck = (scratch_path(spark, n) for n in ("lake", "dlq", "land-ck"))
    blocked = scratch_path(spark, "blocked")
    _touch(spark, blocked)  # a file where the dead letters' folder should be
    records = file_source(spark, src, batch_files)
    try:
        land(records, lake, blocked, ck, available_now=True).awaitTermination()
    except StreamingQueryException:
        pass
    else:
        raise RuntimeError("the batch was to fail after its lake write")
    if not matches(spark, f"{lake}/pair=*"):
        raise RuntimeError("the batch was to reach the lake")
    land(records, lake, dlq, ck, available_now=True).awaitTermination()
    return stable(_lake_cols(read_lake(spark, lake)))


def q_stream_minute_counts(spark, sf_dir):
    """The minute marts streamed as partials per second of latency, merged on read;
    trades in four batches in any order."""
    from ticklake.plans.registry import STREAM_DISORDER, _state_partitions
    from ticklake.streaming import marts as S

    configure(spark)
    root = scratch_path(spark, "minute-counts")
    stg = stg_trades(_trade_stream(spark, sf_dir))
    with _state_partitions(spark):
        S.write_minute_counts(S.stream_minute_counts(stg, STREAM_DISORDER), root, root + "-checkpoint", available_now=True).awaitTermination()
    return stable(_ties_up(S.read_minute_counts(spark, root)))


def _touch(spark, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True).close()


def q_stream_rolling_activity(spark, sf_dir):
    """T4: rolling activity of a streamed minute table, open windows included."""
    from ticklake.plans.registry import STREAM_DISORDER, _state_partitions
    from ticklake.sources.testdata import events_stream, trades_from_events
    from ticklake.streaming import marts as S

    configure(spark)
    stg = stg_trades(trades_from_events(events_stream(spark, sf_dir, max_files_per_trigger=1)))
    root = scratch_path(spark, "stream-rolling")
    with _state_partitions(spark):
        S.write_minute_table(S.stream_minute_marts(stg, STREAM_DISORDER), root, root + "-checkpoint", available_now=True).awaitTermination()
    return stable(S.rolling_from_minutes(S.read_minute_table(spark, root)))


def q_stream_land_dlq(spark, sf_dir):
    """The same landing's dead letters, with the whole payload."""
    from ticklake.streaming.landing import read_dlq

    _, dlq = _land(spark, kafka_records(_dealt_trades(spark, sf_dir)))
    value = lambda k: F.get_json_object("value", f"$.{k}")
    return stable(read_dlq(spark, dlq).select(
        "key", "topic", "partition", "offset", value("error").alias("error"),
        (value("raw") == F.col("payload").cast("string")).alias("payload_whole"),
    ))


def _last_quarter() -> Column:
    return F.col("trade_id") % 4 == 3


def _landed_then_appended(spark, sf_dir, whole: bool = True) -> str:
    """A lake whose first 48 minutes were landed by the stream, the rest appended
    by a batch job; not ``whole``: without its last quarter."""
    trades = _dealt_trades(spark, sf_dir)
    trades = trades if whole else trades.where(~F.coalesce(_last_quarter(), F.lit(False)))
    lake, _ = _land(spark, kafka_records(trades.where(F.col("trade_ts") < CUT_MS), damaged=False))
    write_lake(trades.where(F.col("trade_ts") >= CUT_MS), lake)
    return lake


def q_land_compact_read(spark, sf_dir):
    """Land, append, compact, read."""
    from ticklake.plans.compaction import compact

    lake = _landed_then_appended(spark, sf_dir)
    compact(spark, lake)
    return stable(_lake_cols(read_lake(spark, lake)))


def q_land_external_table(spark, sf_dir):
    """Land, append, compact, external table."""
    from ticklake.plans.compaction import compact

    lake = _landed_then_appended(spark, sf_dir)
    compact(spark, lake)
    return stable(_lake_cols(spark.table(create_external_table(spark, lake, "ext", "landed"))))


def q_compact_concurrent(spark, sf_dir):
    """Small files are compacted while a writer appends; a second compaction
    that stopped after its commit is finished by the next one."""
    from ticklake.plans.compaction import compact, stage_compaction
    from ticklake.sources import files

    lake = _landed_then_appended(spark, sf_dir, whole=False)
    staged = stage_compaction(spark, lake)
    write_lake(_dealt_trades(spark, sf_dir).where(_last_quarter()), lake)  # between the read and the swap
    files.apply(spark, staged.swap)
    stage_compaction(spark, lake)
    compact(spark, lake)
    return stable(_lake_cols(read_lake(spark, lake)))


def _two_days(trades: DataFrame) -> DataFrame:
    """Every second trade moved to the next day."""
    return trades.withColumn("trade_ts", F.col("trade_ts") + F.when(F.col("trade_id") % 2 == 1, F.lit(DAY_MS)).otherwise(F.lit(0)))


def q_catalog_after_incremental(spark, sf_dir):
    """All five marts by table, after a new date was refreshed."""
    configure(spark)
    lake, root = scratch_path(spark, "lake"), scratch_path(spark, "marts")
    trades, db = _two_days(load_trades(spark, sf_dir)), "marts_incremental"
    write_lake(trades.where(F.col("trade_id") % 2 == 0), lake)
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    jobs.refresh_marts(spark, lake, root, as_of=AS_OF, db=db)
    for name in MART_COLUMNS:  # readers that looked before keep nothing stale
        spark.table(f"{db}.{name}").count()
    write_lake(trades.where(F.col("trade_id") % 2 == 1), lake)
    jobs.refresh_dates(spark, lake, root, ["2024-01-02"], as_of=AS_OF, db=db)
    out = None
    for name, cols in MART_COLUMNS.items():
        t = serving.mart_table(spark, name, db)
        part = t.select(
            F.lit(name).alias("mart"), "pair",
            (F.col("minute_bucket") if "minute_bucket" in cols else F.col("max_trade_ts_utc")).alias("at"),
            F.col(cols[1] if "minute_bucket" not in cols else "trade_count").cast("bigint").alias("n"),
        )
        out = part if out is None else out.unionByName(part)
    return stable(out)


def _registered(spark, sf_dir, db: str, select=None) -> str:
    configure(spark)
    lake, root = scratch_path(spark, "lake"), scratch_path(spark, "marts")
    write_lake(load_trades(spark, sf_dir), lake)
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    jobs.refresh_marts(spark, lake, root, select=select, as_of=AS_OF, db=db)
    return lake


def q_health_table(spark, sf_dir):
    """The health mart, read by table."""
    _registered(spark, sf_dir, "marts_health")
    return stable(serving.health_table(spark, "marts_health"))


def q_missing_marts(spark, sf_dir):
    """Required marts that a partial refresh leaves out."""
    _registered(spark, sf_dir, "marts_partial", select=["fct_candles_1m"])
    return spark.createDataFrame([(m,) for m in serving.missing_marts(spark, "marts_partial")], "mart string")


def q_nightly_checks(spark, sf_dir):
    """Q3: the nightly run over the lake and the registered marts."""
    lake = _registered(spark, sf_dir, "marts_nightly")
    return stable(jobs.nightly_checks(spark, lake, db="marts_nightly"))


def _stored_mart(spark, sf_dir, name: str) -> DataFrame:
    """A stored mart with its storage date (what a slice prunes by)."""
    from ticklake.plans.refresh import refresh

    configure(spark)
    paths = refresh(spark, stg_trades(load_trades(spark, sf_dir)), scratch_path(spark, "marts"), select=[name], as_of=AS_OF)
    return spark.read.parquet(paths[name])


def q_candles_slice_stored(spark, sf_dir):
    """R2 on a stored mart: date directories are pruned."""
    return stable(serving.candles_slice(_stored_mart(spark, sf_dir, "fct_candles_1m"), SLICE_PAIR, 30, as_of=AS_OF))


def q_orderflow_slice_stored(spark, sf_dir):
    """R3 on a stored mart."""
    return stable(serving.orderflow_slice(_stored_mart(spark, sf_dir, "fct_orderflow_1m"), SLICE_PAIR, 30, as_of=AS_OF))


# More minutes exist than this, so the n binds.
BINDING_N = 20


def q_trades_slice_stored(spark, sf_dir):
    """R4/K3 on a stored mart, with an n that binds."""
    return stable(serving.trades_slice(_stored_mart(spark, sf_dir, "fct_trades_1m"), SLICE_PAIR, 1440, as_of=AS_OF, n=BINDING_N))


def q_late_reconciled(spark, sf_dir):
    """Trades in four shuffled batches, a watermark that many of them miss;
    the late ones are kept aside and their date is rebuilt in the same table."""
    from ticklake.streaming import marts as SM

    configure(spark)
    trades = _dealt_trades(spark, sf_dir)
    (src, batch_files), root, side = _in_files(trades, spark, "trades"), scratch_path(spark, "minutes"), scratch_path(spark, "late")
    stream = lambda: stg_trades(spark.readStream.schema(TRADE_V1).option("maxFilesPerTrigger", batch_files).parquet(src))
    SM.write_minute_table(SM.stream_minute_marts(stream(), "1 minute"), root, scratch_path(spark, "ck"), available_now=True).awaitTermination()
    SM.late_rows(stream(), side, scratch_path(spark, "ck"), "1 minute", available_now=True).awaitTermination()
    late = spark.read.parquet(f"{side}/late")
    dates = [str(r[0]) for r in late.select("trade_date").distinct().collect()]
    lake = scratch_path(spark, "lake")
    write_lake(trades, lake)
    SM.reconcile_minutes(stg_trades(read_lake(spark, lake)), root, dates)
    return stable(_ties_up(SM.read_minute_table(spark, root)))


def q_late_split(spark, sf_dir):
    """T5: one query parts late trades from trades in time; the table with both."""
    from ticklake.streaming import marts as S

    configure(spark)
    root, side = scratch_path(spark, "minute-counts"), scratch_path(spark, "late")
    stg = stg_trades(_trade_stream(spark, sf_dir))
    S.split_late(stg, root, side, scratch_path(spark, "ck"), "1 minute", available_now=True).awaitTermination()
    return stable(_ties_up(S.read_split(spark, root, side)))


def _wide_marts(spark, root: str) -> DataFrame:
    """The four stored minute marts side by side."""
    mart = lambda name: read_mart(spark, f"{root}/{name}")
    keys, seen = ["pair", "minute_bucket"], None
    latency = mart("fct_ingestion_latency_1m").withColumnRenamed("trade_count", "latency_count")
    for df in (mart("fct_candles_1m"), mart("fct_trades_1m"), mart("fct_orderflow_1m"), latency):
        seen = df if seen is None else seen.join(df.select(*keys, *(c for c in df.columns if c not in seen.columns)), keys, "left")
    return seen.drop("min_price", "max_price")


def _ties_up(wide: DataFrame) -> DataFrame:
    """Averages of 2-decimal prices can end in a tie at the 6th decimal, where sums
    in another order round either way: lifted above it on both sides."""
    return wide.withColumn("avg_price", F.col("avg_price") + 1e-9)


def _trade_stream(spark, sf_dir) -> DataFrame:
    """All trades as a stream of BATCHES micro-batches, in no order of time."""
    src, batch_files = _in_files(_dealt_trades(spark, sf_dir), spark, "trades")
    return spark.readStream.schema(TRADE_V1).option("maxFilesPerTrigger", batch_files).parquet(src)


def q_stream_dedupe_earliest(spark, sf_dir):
    """Every trade delivered twice, in four batches in no order; the stream keeps
    the earliest ingest, as the batch rule does. All staging columns."""
    from ticklake.plans.registry import _state_partitions
    from ticklake.streaming import marts as SM

    configure(spark)
    src, batch_files = _in_files(_dealt(spark, with_redelivery(_dealt_trades(spark, sf_dir))), spark, "trades")
    stream = stg_trades(spark.readStream.schema(TRADE_V1).option("maxFilesPerTrigger", batch_files).parquet(src))
    root = scratch_path(spark, "deduped")
    with _state_partitions(spark):
        SM.write_versions(SM.dedupe_updates(stream, "30 days"), root, scratch_path(spark, "ck"), SM.TRADE_KEYS, available_now=True).awaitTermination()
    return stable(SM.read_versions(spark, root, SM.TRADE_KEYS).select(*stream.columns))


def _merged_marts(spark, sf_dir) -> str:
    from ticklake.streaming.marts import scheduled_merge

    configure(spark)
    root = scratch_path(spark, "marts")
    scheduled_merge(_trade_stream(spark, sf_dir), scratch_path(spark, "partials"), root, scratch_path(spark, "ck"),
                    available_now=True, as_of=AS_OF).start().awaitTermination()
    return root


def q_refresh_merged(spark, sf_dir):
    """Four micro-batches merged into the marts by their partials; all minute marts."""
    return stable(_ties_up(_wide_marts(spark, _merged_marts(spark, sf_dir))))


def q_refresh_merged_health(spark, sf_dir):
    """The same run's health report."""
    return stable(read_mart(spark, f"{_merged_marts(spark, sf_dir)}/fct_pipeline_health_5m"))


def q_scheduled_refresh(spark, sf_dir):
    """Micro-batches landed one by one, each followed by a rebuild of its dates."""
    from ticklake.streaming.marts import scheduled_refresh

    configure(spark)
    lake, root = scratch_path(spark, "lake"), scratch_path(spark, "marts")
    write_lake(load_trades(spark, sf_dir), lake)
    scheduled_refresh(_trade_stream(spark, sf_dir), lake, root, scratch_path(spark, "ck"), available_now=True).start().awaitTermination()
    return stable(_ties_up(_wide_marts(spark, root)))


def q_unkeyed_range_read(spark, sf_dir):
    """Time-range read of the un-keyed layout, by directory globs."""
    configure(spark)
    root, trades = scratch_path(spark, "plain"), ingest.with_partition_values(load_trades(spark, sf_dir))
    for pair, date, hour in trades.select(*LAKE_PARTITION_COLS).distinct().collect():  # the fixture's few directories
        part = trades.where((F.col("pair") == pair) & (F.col("trade_date") == F.lit(date)) & (F.col("hour") == hour))
        part.select(*TRADE_V1_REQUIRED).write.parquet(partition_dir(root, "trades", pair, str(date), f"{hour:02d}"))
    return stable(_lake_cols(read_trades(spark, root, RANGE_START, RANGE_END, layout="plain")))


def _plain_tree(trades: DataFrame, spark, kinds: dict) -> str:
    """An un-keyed tree; ``kinds`` maps trade_id % len(kinds) to what its files hold."""
    root = scratch_path(spark, "plain")
    rows = ingest.with_partition_values(trades)
    for pair, date, hour in rows.select(*LAKE_PARTITION_COLS).distinct().collect():  # the fixture's few directories
        part = rows.where((F.col("pair") == pair) & (F.col("trade_date") == F.lit(date)) & (F.col("hour") == hour))
        for kind, cols in kinds.items():
            mine = part.where(F.col("trade_id") % len(kinds) == kind).select(*TRADE_V1_REQUIRED).withColumns(cols)
            mine.write.mode("append").parquet(partition_dir(root, "trades", pair, str(date), f"{hour:02d}"))
    return root


def q_plain_table_range(spark, sf_dir):
    """A table over the un-keyed tree in place; a range of it."""
    from ticklake.sources.plain import create_plain_table

    configure(spark)
    table = create_plain_table(spark, _plain_tree(load_trades(spark, sf_dir), spark, {0: {}}), db="ext_plain")
    rows = spark.sql(
        f"SELECT * FROM {table} WHERE pair = '{SLICE_PAIR}' AND trade_date = DATE '2024-01-01' AND hour <= 1 "
        f"AND trade_ts >= {BASE_MS + 30 * 60_000} AND trade_ts < {BASE_MS + 45 * 60_000}"
    )
    return stable(_lake_cols(rows))


def q_drifted_files(spark, sf_dir):
    """Files with double, integer and text prices in the same directories."""
    from ticklake.sources.plain import read_drifted

    configure(spark)
    whole = {c: F.floor(c).cast("bigint") for c in ("price", "qty")}
    text = {"price": F.col("price").cast("string"), "schema_version": F.col("schema_version").cast("int")}
    root = _plain_tree(load_trades(spark, sf_dir), spark, {0: {}, 1: whole, 2: text})
    return stable(_lake_cols(read_drifted(spark, root)))


def q_staging_view(spark, sf_dir):
    """The catalog's staging view, read by name from another session."""
    configure(spark)
    lake = scratch_path(spark, "lake")
    write_lake(load_trades(spark, sf_dir), lake)
    name = create_staging_view(spark, create_external_table(spark, lake, "ext", "for_view"), "stg.stg_trades")
    other = spark.newSession()
    configure(other)
    return stable(other.table(name))


def _damaged_feed(spark, sf_dir) -> DataFrame:
    """Raw messages; trade_id % 7 chooses: 0 no JSON, 1 no price key, 2 price "x",
    3 trade time null, 4 trade time in nanoseconds, 5 and 6 intact."""
    d = F.col("offset") % 7
    text = F.col("value")
    damaged = (
        F.when(d == 0, F.concat(F.lit("{nope"), F.col("offset").cast("string")))
        .when(d == 1, F.regexp_replace(text, '"p":"[^"]*",', ""))
        .when(d == 2, F.regexp_replace(text, '"p":"[^"]*"', '"p":"x"'))
        .when(d == 3, F.regexp_replace(text, '"T":[0-9]+', '"T":null'))
        .when(d == 4, F.regexp_replace(text, '("T":[0-9]+)', "$1000000"))
        .otherwise(text)
    )
    return feed_messages(load_trades(spark, sf_dir)).select(damaged.alias("value"))


def _published(spark, sf_dir, topic: str) -> DataFrame:
    from ticklake.streaming.feed import feed_text_source, publish, read_topic

    configure(spark)
    src, out, ck = (scratch_path(spark, n) for n in ("feed", "topics", "publish-ck"))
    _damaged_feed(spark, sf_dir).repartition(BATCHES).write.text(src)
    publish(feed_text_source(spark, src), ck, out_root=out, trades_topic="good", dlq_topic="dead", available_now=True).awaitTermination()
    return read_topic(spark, out, topic)


def q_publish_feed(spark, sf_dir):
    """The feed's good events as published."""
    event = F.from_json("value", TRADE_V1).alias("e")
    rows = _published(spark, sf_dir, "good").select("key", event)
    return stable(rows.select("key", *(f"e.{c}" for c in ("symbol", "trade_id", "trade_ts", "price", "qty", "is_buyer_maker"))))


def q_publish_dlq(spark, sf_dir):
    """The feed's dead letters: error code and original text."""
    rows = _published(spark, sf_dir, "dead")
    return stable(rows.select("key", F.get_json_object("value", "$.error").alias("error"), F.col("payload").cast("string").alias("text")))


def q_refresh_deduped(spark, sf_dir):
    """A lake where every trade was delivered twice, refreshed once-only."""
    configure(spark)
    lake, root = scratch_path(spark, "lake"), scratch_path(spark, "marts")
    write_lake(with_redelivery(load_trades(spark, sf_dir)), lake)
    paths = jobs.refresh_marts(spark, lake, root, as_of=AS_OF, db=None, dedupe=True)
    return stable(read_mart(spark, paths["fct_candles_1m"]))


QUERIES = {
    "contract_minimal": q_contract_minimal,
    "stream_land_lake": q_stream_land_lake,
    "stream_land_dlq": q_stream_land_dlq,
    "land_crash_replay": q_land_crash_replay,
    "stream_minute_counts": q_stream_minute_counts,
    "stream_rolling_activity": q_stream_rolling_activity,
    "land_compact_read": q_land_compact_read,
    "land_external_table": q_land_external_table,
    "catalog_after_incremental": q_catalog_after_incremental,
    "health_table": q_health_table,
    "missing_marts": q_missing_marts,
    "nightly_checks": q_nightly_checks,
    "candles_slice_stored": q_candles_slice_stored,
    "orderflow_slice_stored": q_orderflow_slice_stored,
    "trades_slice_stored": q_trades_slice_stored,
    "late_reconciled": q_late_reconciled,
    "late_split": q_late_split,
    "stream_dedupe_earliest": q_stream_dedupe_earliest,
    "refresh_merged": q_refresh_merged,
    "refresh_merged_health": q_refresh_merged_health,
    "scheduled_refresh": q_scheduled_refresh,
    "compact_concurrent": q_compact_concurrent,
    "plain_table_range": q_plain_table_range,
    "drifted_files": q_drifted_files,
    "staging_view": q_staging_view,
    "unkeyed_range_read": q_unkeyed_range_read,
    "publish_feed": q_publish_feed,
    "publish_dlq": q_publish_dlq,
    "refresh_deduped": q_refresh_deduped,
}
