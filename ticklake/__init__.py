"""ticklake — a Spark-native trade lake.

Trade events are contract-checked, routed (good rows to a partitioned
Parquet lake, bad rows to a dead-letter stream), staged into a typed
view and rolled up into minute-grain marts (trades, candles, order
flow, ingestion latency) plus a per-pair pipeline-health report.

Every transform is ``DataFrame -> DataFrame`` built from Catalyst
expressions; the same definitions run as batch refreshes and as
Structured Streaming queries.
"""

from ticklake.session import configure, get_session, scratch_path

__all__ = ["configure", "get_session", "scratch_path"]
