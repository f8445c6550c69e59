"""Session setup shared by jobs, tests and the bench.

Two settings are load-bearing for correctness and are applied to any
session handed to the library (``configure``):

* ``spark.sql.session.timeZone=UTC`` — every timestamp in the data model
  is UTC; ``to_date``/``hour``/``date_trunc`` follow the session zone.
* a reliable checkpoint directory — lineage is cut by writing to the
  shared folder named in ``spark.checkpoint.dir`` (never a machine-local
  temp folder on a cluster). Only when the session has none (local
  tests) do we create one.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL confs we rely on. AQE re-plans at runtime: coalesces small
# shuffle partitions and splits skewed join partitions (one hot pair can
# hold a third of all rows). Write modes (compression, dynamic partition
# overwrite) are set per write, never session-wide.
_SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # stateful streaming operators keep their state in RocksDB (off-heap)
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(
    master: str | None = None,
    app_name: str = "ticklake",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    On a cluster leave ``master``/``shuffle_partitions`` unset: the
    deployment decides them (AQE coalesces partitions anyway).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false")
    for k, v in _SQL_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the data model needs (idempotent)."""
    for k, v in _SQL_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's reliable checkpoint folder.

    Read from the session (the context's checkpoint dir, else the
    ``spark.checkpoint.dir`` setting). If neither is set, a local master
    (tests) gets a fresh folder; on a cluster this raises, because each
    executor has its own disk and later reads would miss the files.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local SparkContext (Spark Connect)
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir and sc is not None:
        conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc is None or not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="ticklake-ckpt-")
    if sc is None:
        return conf_dir
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder.

    Used for lake roots, streaming checkpoints and staged tables created
    by jobs and queries; each call gets its own folder (never reused,
    never cleared).
    """
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/ticklake/{name}-{uuid.uuid4().hex[:12]}"


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme for local-only helpers (tests)."""
    if uri.startswith("file:"):
        p = uri[len("file:"):]
        while p.startswith("//"):
            p = p[1:]
        return p
    return uri


def default_sf_dir() -> str:
    return os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
