"""Producer side: raw exchange messages -> trade_v1 events on the trade topic.

Raw feed messages (one JSON text per record, landed as text files or
read from a raw topic) are normalised, contract-checked and published:
events that pass go to the trade topic keyed by symbol, events that fail
go to the dead-letter topic — the documented intent; nothing is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ticklake.operators import ingest
from ticklake.streaming.sources import TRIGGER_INTERVAL, apply_trigger


def feed_text_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed raw feed: text files, one JSON message per line (``value``)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def feed_dlq(bad: DataFrame, text_col: str = "value", topic: str = "feed") -> DataFrame:
    """Failed messages -> DLQ records; ``raw`` and ``payload`` hold the original text.

    A raw topic's own topic/partition/offset are kept; landed text files have
    none and are keyed ``feed:0``.
    """
    have = set(bad.columns)
    place = [
        (F.col(c) if c in have else F.lit(v).cast(kind)).alias(c)
        for c, v, kind in (("topic", topic, "string"), ("partition", 0, "int"), ("offset", None, "bigint"))
    ]
    return ingest.to_dlq(bad.select(F.col(text_col).alias("_text"), "error", *place), value_col="_text", whole=True)


def publish_batch(checked: DataFrame, batch_id: int, write) -> None:
    """Split one checked micro-batch and hand both halves to ``write``."""
    checked = checked.persist()
    try:
        write(ingest.encode_event(ingest.good_rows(checked)), "trades", batch_id)
        write(feed_dlq(ingest.bad_rows(checked)), "dlq", batch_id)
    finally:
        checked.unpersist()


def publish(raw: DataFrame, checkpoint_root: str, bootstrap: str | None = None,
            trades_topic: str = "crypto.trades.v1", dlq_topic: str = "crypto.trades.dlq.v1",
            out_root: str | None = None, trigger: str | None = TRIGGER_INTERVAL,
            available_now: bool = False, text_col: str = "value", **ids) -> StreamingQuery:
    """Normalise + check the raw feed once and publish both outcomes.

    With ``bootstrap`` the sinks are Kafka topics (acks=all, at least once);
    otherwise ``out_root/<topic>/batch=<id>`` Parquet folders with the same
    ``key, value`` columns, replaced when a batch is replayed. ``ids`` go to
    ``ingest.check_feed`` (event_id, ingested_at, source).
    """
    topics = {"trades": trades_topic, "dlq": dlq_topic}

    def write(df: DataFrame, kind: str, batch_id: int) -> None:
        if bootstrap:
            (
                df.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value").write.format("kafka")
                .option("kafka.bootstrap.servers", bootstrap).option("topic", topics[kind]).option("kafka.acks", "all").save()
            )
        else:
            df.write.mode("overwrite").parquet(f"{out_root.rstrip('/')}/{topics[kind]}/batch={batch_id}")

    checked = ingest.check_feed(raw.withColumnRenamed(text_col, "value"), **ids)
    w = checked.writeStream.foreachBatch(lambda batch, batch_id: publish_batch(batch, batch_id, write)).option(
        "checkpointLocation", f"{checkpoint_root.rstrip('/')}/query"
    )
    return apply_trigger(w, trigger, available_now).start()


def read_topic(spark: SparkSession, out_root: str, topic: str) -> DataFrame:
    """What ``publish`` wrote for a topic, without the folder column."""
    return spark.read.parquet(f"{out_root.rstrip('/')}/{topic}").drop("batch")
