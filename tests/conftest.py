"""Shared fixtures: one local session for the whole test run."""

from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

M = 1704067200000  # 2024-01-01T00:00:00Z in epoch ms (a minute start)
SMOKE_DIR = "/root/testdata/sf0.001"
ORACLE_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ticklake.session import get_session

    # one JVM runs every test: room for it, and no long memory of past queries
    extra = {"spark.driver.memory": "6g", "spark.sql.ui.retainedExecutions": "20", "spark.ui.retainedJobs": "50",
             "spark.ui.retainedStages": "50", "spark.ui.showConsoleProgress": "false"}
    s = get_session("local[4]", app_name="ticklake-tests", shuffle_partitions=4, extra=extra)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def iso(ms: int) -> str:
    return dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc).isoformat()


def trades_df(spark, rows, ingest_offset_ms: int = 1000, ingested=None):
    """trade_v1 rows from (symbol, trade_id, trade_ts, price, qty, maker).

    ``ingested`` (list) overrides ingested_at per row.
    """
    from ticklake.schema import TRADE_V1

    out = []
    for i, (sym, tid, ts, price, qty, maker) in enumerate(rows):
        ing = ingested[i] if ingested is not None else iso(ts + ingest_offset_ms)
        out.append((1, f"e{tid}-{i}", "test", ing, sym, tid, ts, float(price), float(qty), maker))
    nullable = TRADE_V1.__class__([f.__class__(f.name, f.dataType, True) for f in TRADE_V1.fields])
    return spark.createDataFrame(out, nullable)


def stg_of(spark, rows, **kw):
    from ticklake.operators.staging import stg_trades

    return stg_trades(trades_df(spark, rows, **kw))


@pytest.fixture(scope="session")
def spark_hyp(spark):
    """Same session; separate name so hypothesis does not warn about
    function-scoped fixtures."""
    return spark
