"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is fully executed into Spark's ``noop`` sink (no driver
collect), best of $BENCH_REPEATS runs after one warm-up. Prints ONE
JSON line: {"metric", "value" (sum of per-query seconds), "unit",
"queries": {name: sec}, "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

HEADLINE = (
    "stg_trades",
    "fct_trades_1m",
    "fct_candles_1m",
    "fct_orderflow_1m",
    "fct_ingestion_latency_1m",
    "fct_pipeline_health_5m",
    "refresh_roundtrip",
    "quality_not_null",
    "dedupe_trades",
    "candles_slice",
    "latest_candles_top5",
    "contract_check",
    "dlq_payload",
    "lake_roundtrip",
    "stream_minute_marts",
    "rolling_activity_5m",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from ticklake.plans.registry import QUERIES
    from ticklake.session import get_session

    spark = get_session(f"local[{cpus}]", app_name="ticklake-bench", shuffle_partitions=int(cpus),
                        extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    # Warm-up: JVM, codegen caches, file listing.
    run("fct_candles_1m")
    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name in only or HEADLINE:
        try:
            best = min(run(name) for _ in range(max(1, repeats)))
            times[name] = round(best, 3)
        except Exception as e:  # keep measuring the rest; report the failure
            times[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(t for t in times.values() if t is not None), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "repeats": repeats,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
