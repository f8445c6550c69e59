"""Write PLANS.md: a per-query summary of the executed (final AQE) plans.

    python tests/plan_report.py [sf_dir]

For each registered query of the trade lake: shuffles, reused exchanges, aggregate
operators, joins, broadcasts, and what reached the Parquet scan.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


def summarize(plan: str) -> dict:
    if "== Final Plan ==" in plan:
        plan = plan.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    lines = plan.splitlines()
    ops = [re.split(r"[ (\[]", re.sub(r"^[\s:+\-*()\d]*", "", ln))[0] for ln in lines]

    def count(name):
        return sum(1 for o in ops if o == name)

    aggs = sorted({o for o in ops if o.endswith("Aggregate")})
    joins = sorted({o for o in ops if o.endswith("Join")})
    scans = [ln for ln in lines if "FileScan" in ln or "Scan parquet" in ln]
    schema = set()
    pushed = set()
    parts = set()
    for s in scans:
        m = re.search(r"ReadSchema: struct<([^>]*)>", s)
        if m:
            schema.add(",".join(f.split(":")[0] for f in m.group(1).split(",")))
        m = re.search(r"PushedFilters: \[([^\]]*)\]", s)
        if m and m.group(1):
            pushed.add(m.group(1)[:80])
        m = re.search(r"PartitionFilters: \[([^\]]*)\]", s)
        if m and m.group(1):
            parts.add(m.group(1)[:80])
    return {
        "shuffles": count("Exchange"),
        "reused": count("ReusedExchange"),
        "aggregates": " ".join(aggs) or "-",
        "joins": " ".join(joins) or "-",
        "broadcast": "yes" if "BroadcastExchange" in plan else "-",
        "scan_columns": " / ".join(sorted(schema)) or "-",
        "pushed": " / ".join(sorted(pushed)) or "-",
        "partition_filters": " / ".join(sorted(parts)) or "-",
    }


def main(argv):
    from ticklake.plans.registry import queries
    from ticklake.session import get_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    rows = []
    for name, fn in queries().items():
        df = fn(spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        rows.append((name, summarize(plan)))
    cols = ["shuffles", "reused", "aggregates", "joins", "broadcast", "scan_columns", "pushed", "partition_filters"]
    out = [
        "# Executed plans (final AQE plans, sf0.01, local[8])",
        "",
        "Generated by `python tests/plan_report.py`. `shuffles` counts Exchange nodes in the",
        "final plan of the returned DataFrame (writes done inside a query — lake, refresh,",
        "snapshot, stream sink — are separate jobs and not counted). Range-partitioning",
        "exchanges come from `orderBy` on small results.",
        "",
        "| query | " + " | ".join(cols) + " |",
        "| --- | " + " | ".join("---" for _ in cols) + " |",
    ]
    for name, s in rows:
        out.append(f"| {name} | " + " | ".join(str(s[c]).replace("|", "/") for c in cols) + " |")
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    print("\n".join(out))


if __name__ == "__main__":
    main(sys.argv)
