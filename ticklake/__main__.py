"""Command line: ``python -m ticklake <command> [options]``.

Commands: ``init-catalog``, ``refresh`` (full, or ``--dates`` incremental),
``checks``, ``report``, ``migrate`` (un-keyed -> keyed layout), ``compact``.
Roots are URIs on shared storage (``s3a://…``, ``hdfs://…`` or ``file:``).
"""

from __future__ import annotations

import argparse
import sys


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="ticklake")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("init-catalog")
    a.add_argument("--lake", required=True)
    a.add_argument("--catalog-root", required=True)
    r = sub.add_parser("refresh")
    r.add_argument("--lake", required=True)
    r.add_argument("--marts", required=True)
    r.add_argument("--select", nargs="*")
    r.add_argument("--as-of")
    r.add_argument("--snapshot-ts")
    r.add_argument("--dates", nargs="*", help="incremental: rebuild only these trade dates")
    c = sub.add_parser("checks")
    c.add_argument("--lake", required=True)
    c.add_argument("--db", default="marts")
    q = sub.add_parser("report")
    q.add_argument("--db", default="marts")
    g = sub.add_parser("migrate")
    g.add_argument("--src", required=True, help="root of the un-keyed layout")
    g.add_argument("--lake", required=True)
    k = sub.add_parser("compact")
    k.add_argument("--lake", required=True)
    k.add_argument("--date", nargs="*", help="dates to compact (default: all)")
    args = p.parse_args(argv)

    from ticklake.plans import jobs
    from ticklake.session import get_session

    spark = get_session()
    if args.cmd == "init-catalog":
        for row in jobs.init_catalog(spark, args.lake, args.catalog_root):
            print(row)
    elif args.cmd == "refresh":
        if args.dates:
            paths = jobs.refresh_dates(spark, args.lake, args.marts, args.dates, args.as_of)
        else:
            paths = jobs.refresh_marts(spark, args.lake, args.marts, args.select, args.as_of,
                                       snapshot_ts=args.snapshot_ts)
        for name, path in paths.items():
            print(name, path)
    elif args.cmd == "checks":
        jobs.nightly_checks(spark, args.lake, args.db).show(truncate=False)
    elif args.cmd == "report":
        for title, df in jobs.report(spark, args.db).items():
            print(f"\n{title}:\n")
            df.show(truncate=False)
    elif args.cmd == "migrate":
        jobs.migrate_unkeyed(spark, args.src, args.lake)
    elif args.cmd == "compact":
        from ticklake.plans.compaction import compact

        print(compact(spark, args.lake, args.date or None))
    return 0


if __name__ == "__main__":
    sys.exit(main())
