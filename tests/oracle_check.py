"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Mimics the driver's gate: row count, column names, and an
order-insensitive comparison of values (columns sorted by name).

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (list, tuple, dict)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, name: str, sf_dir: str, sql: str | None, fn) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_names = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    res = {"query": name, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = duck_connect(sf_dir)
    cur = con.execute(sql)
    d_names = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    res["oracle_rows"] = len(d_rows)
    if sorted(s_names) != sorted(d_names):
        res["status"] = f"COLUMNS differ spark={sorted(s_names)} oracle={sorted(d_names)}"
        return res
    a, b = _rows(s_names, s_rows), _rows(d_names, d_rows)
    if a == b:
        res["status"] = "match"
    else:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["status"] = f"VALUES differ (first diffs: {diff})"
    return res


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from ticklake.session import get_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    sqls = oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if only and name not in only:
            continue
        try:
            res = compare(spark, name, sf_dir, sqls.get(name), fn)
        except Exception as e:  # report and continue
            res = {"query": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if res["status"] not in ("match", "rows-only"):
            bad += 1
        print(res, flush=True)
    print(f"bad={bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
