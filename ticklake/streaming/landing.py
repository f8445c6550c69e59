"""Stream landing: records -> contract check -> lake (good) / DLQ (bad).

One query, one parse per record: each micro-batch is checked, kept for the
two writes and split. The lake is written by the same ``write_lake`` that
batch jobs use — rows rebalanced by directory, no sink log in the lake's
root — so landing, batch appends, compaction and external tables all see
one set of files.

A batch may be replayed after a failure. The dead letters of a batch have a
folder of their own and are replaced. For the lake, a ledger beside the
checkpoint notes which batches began and which are done: a finished batch
is skipped, and of a broken one only the events that are not in the lake
yet are written.
"""

from __future__ import annotations

import zlib
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ticklake.operators import ingest
from ticklake.sources.lake import lake_frame, matches, read_lake, write_lake
from ticklake.streaming.sources import TRIGGER_INTERVAL, apply_trigger

METRICS_NAME = ingest.METRICS_NAME
# What tells events apart: the producer's id, and the trade it reports.
EVENT_KEY = ("event_id", "symbol", "trade_id", "trade_ts")
# Finished batches that the ledger remembers (a replay is never older).
LEDGER_KEEP = 100


class Ledger:
    """Empty marker files ``<batch_id>.begun`` / ``.done`` on shared storage."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, batch_id: int, state: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{batch_id}.{state}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def has(self, batch_id: int, state: str) -> bool:
        fs, path = self._path(batch_id, state)
        return fs.exists(path)

    def note(self, batch_id: int, state: str) -> None:
        fs, path = self._path(batch_id, state)
        fs.create(path, True).close()

    def forget(self, batch_id: int) -> None:
        for state in ("begun", "done"):
            fs, path = self._path(batch_id, state)
            fs.delete(path, False)


def not_landed(good: DataFrame, lake_root: str) -> DataFrame:
    """Events of a broken batch that the lake does not hold yet.

    Only the partitions of the batch's dates are read (the dates of one
    micro-batch are a handful of values).
    """
    spark = good.sparkSession
    if not matches(spark, f"{lake_root.rstrip('/')}/pair=*"):
        return good
    dates = [r[0] for r in lake_frame(good).select("trade_date").distinct().collect()]
    there = read_lake(spark, lake_root).where(F.col("trade_date").isin(*map(F.lit, dates))).select(*EVENT_KEY)
    return good.join(there, list(EVENT_KEY), "left_anti")


def land_batch(checked: DataFrame, lake_root: str, dlq_root: str | None, ledger: Ledger, batch_id: int,
               run: str = "0", max_bytes: int = ingest.DLQ_MAX_BYTES, dlq_kafka: dict | None = None) -> None:
    """Write one checked micro-batch; doing it again adds nothing."""
    if ledger.has(batch_id, "done"):
        return
    again = ledger.has(batch_id, "begun")
    ledger.note(batch_id, "begun")
    checked = checked.persist()
    try:
        good = ingest.good_rows(checked)
        write_lake(not_landed(good, lake_root) if again else good, lake_root)
        dead = ingest.to_dlq(ingest.bad_rows(checked), max_bytes, whole=True)
        if dlq_kafka:
            dead.select("key", "value").write.format("kafka").options(**dlq_kafka).save()
        else:
            dead.write.mode("overwrite").parquet(f"{dlq_root.rstrip('/')}/run={run}/batch={batch_id}")
    finally:
        checked.unpersist()
    ledger.note(batch_id, "done")
    ledger.forget(batch_id - LEDGER_KEEP)


def land(records: DataFrame, lake_root: str, dlq_root: str | None, checkpoint_root: str,
         mode: str = ingest.FULL, trigger: str | None = TRIGGER_INTERVAL,
         available_now: bool = False, max_bytes: int = ingest.DLQ_MAX_BYTES,
         dlq_bootstrap: str | None = None, dlq_topic: str = "crypto.trades.dlq.v1") -> StreamingQuery:
    """Start landing a Kafka-shaped record stream.

    Good rows go to the lake, dead letters to Parquet under ``dlq_root`` (the
    JSON envelope plus the whole payload) or, with ``dlq_bootstrap``, to the
    ``dlq_topic`` Kafka topic (at least once). Every record goes to exactly
    one of the two. The ingest counters are observed per batch.
    """
    spark, ck = records.sparkSession, checkpoint_root.rstrip("/")
    ledger = Ledger(spark, f"{ck}/landed")
    kafka = {"kafka.bootstrap.servers": dlq_bootstrap, "topic": dlq_topic, "kafka.acks": "all"} if dlq_bootstrap else None
    run = f"{zlib.crc32(ck.encode()):08x}"  # streams that share a DLQ do not share batch folders
    checked = ingest.check_contract(records, mode, metrics_name=METRICS_NAME)
    w = checked.writeStream.foreachBatch(
        lambda batch, batch_id: land_batch(batch, lake_root, dlq_root, ledger, batch_id, run, max_bytes, kafka)
    ).option("checkpointLocation", f"{ck}/query")
    return apply_trigger(w, trigger, available_now).start()


def read_dlq(spark: SparkSession, dlq_root: str) -> DataFrame:
    """Dead letters of every batch, without the folder columns."""
    return spark.read.parquet(dlq_root).drop("run", "batch")


class IngestMetricsListener(StreamingQueryListener):
    """Counters observed per micro-batch, the newest ``keep`` of them.

    Register with ``spark.streams.addListener``; ``rows`` holds one dict per
    batch (consumed, landed, dead_lettered, batch_id), ``totals`` their sums.
    """

    def __init__(self, keep: int = 1000):
        self.rows: deque[dict] = deque(maxlen=keep)
        self.totals = {"consumed": 0, "landed": 0, "dead_lettered": 0}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        m = event.progress.observedMetrics.get(METRICS_NAME)
        if m is not None:
            row = m.asDict()
            for k in self.totals:
                self.totals[k] += row[k]
            row["batch_id"] = event.progress.batchId
            self.rows.append(row)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
