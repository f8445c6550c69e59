"""Stream sources and sinks.

Production reads the trade topic from Kafka; the Kafka connector jar is
not bundled, so tests drive the same pipeline from a file source that
yields the identical Kafka-shaped columns (``key, value, topic,
partition, offset, timestamp``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from ticklake.schema import KAFKA_RECORD

# Flush size (records) and interval, producer linger (ms) — the
# ingest cadence of the surveyed deployment: a batch is written at 5,000
# records or after 10 seconds, whichever comes first. The size starts a batch;
# it never limits one.
FLUSH_RECORDS = 5000
TRIGGER_INTERVAL = "10 seconds"
PRODUCER_LINGER_MS = 20


def kafka_source(spark: SparkSession, bootstrap: str, topic: str,
                 starting_offsets: str = "earliest",
                 max_offsets_per_trigger: int | None = None,
                 fail_on_data_loss: bool = True, flush_records: int | None = FLUSH_RECORDS,
                 group_id: str | None = None, options: dict | None = None) -> DataFrame:
    """Subscribe to ``topic``; offsets are tracked in the query checkpoint.

    Structured Streaming commits source offsets only after a micro-batch's
    sink commit, which replaces the reference's manual commit-after-write.

    ``flush_records`` waits for so many records, but no longer than the
    trigger interval. A ceiling (``max_offsets_per_trigger``) is off unless
    asked for, and records that the topic has already dropped stop the query
    (``fail_on_data_loss``) instead of being skipped.
    """
    r = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if flush_records:
        r = r.option("minOffsetsPerTrigger", str(flush_records)).option("maxTriggerDelay", TRIGGER_INTERVAL)
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if group_id:
        r = r.option("kafka.group.id", group_id)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load()


def file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                fmt: str = "parquet") -> DataFrame:
    """Kafka-shaped records landed as files (test and replay source)."""
    r = spark.readStream.schema(KAFKA_RECORD).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def kafka_sink(records: DataFrame, bootstrap: str, topic: str, checkpoint: str,
               options: dict | None = None) -> DataStreamWriter:
    """Writer publishing ``key, value`` records: acks=all, idempotent producer."""
    w = (
        records.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("topic", topic)
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .option("kafka.linger.ms", str(PRODUCER_LINGER_MS))
        .option("checkpointLocation", checkpoint)
    )
    for k, v in (options or {}).items():
        w = w.option(k, v)
    return w


# State for watermarked aggregations and dedupe lives in RocksDB on local
# disk (checkpointed to the query's checkpoint folder), not on the heap:
# dedupe keeps every trade key for the watermark span.
STATE_STORE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Select the RocksDB state store (must be set before a query's first start)."""
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) != STATE_STORE_PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE_PROVIDER)


def apply_trigger(w: DataStreamWriter, trigger: str | None = TRIGGER_INTERVAL,
                  available_now: bool = False) -> DataStreamWriter:
    """Fixed-interval micro-batches, or drain what is available and stop."""
    if available_now:
        return w.trigger(availableNow=True)
    if trigger:
        return w.trigger(processingTime=trigger)
    return w
