"""Job entry points: catalog init, refresh, nightly checks, report."""

from __future__ import annotations

import pytest
from conftest import M, SMOKE_DIR, iso, trades_df

from ticklake.operators import quality
from ticklake.plans import jobs, partials
from ticklake.plans.refresh import ALL_MARTS, read_mart
from ticklake.session import scratch_path
from ticklake.sources import files
from ticklake.sources.lake import write_lake
from ticklake.sources.testdata import load_trades, with_redelivery


def test_jobs_end_to_end(spark):
    lake, marts_root, cat = (scratch_path(spark, n) for n in ("j-lake", "j-marts", "j-cat"))
    write_lake(load_trades(spark, SMOKE_DIR), lake)
    listing = jobs.init_catalog(spark, lake, cat)
    assert ("trades", "EXTERNAL") in listing
    assert spark.table("ext.trades").count() == 1000
    paths = jobs.refresh_marts(spark, lake, marts_root, as_of="2024-01-01 01:10:00", db="marts_j")
    assert len(paths) == 5
    checks = jobs.nightly_checks(spark, lake, db="marts_j")
    assert checks.count() == 15 and checks.where("failures > 0").count() == 0
    rep = jobs.report(spark, "marts_j")
    assert [df.count() for df in rep.values()] == [5, 5, 5, 5, 5]
    from ticklake.operators import serving

    panels = serving.dashboard(spark, "marts_j", lookback_minutes=30, as_of="2024-01-01 01:10:00")
    assert [r.pair for r in panels["pairs"].collect()] == ["CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW"]
    assert panels["health"].count() == 5
    assert panels["latest"].count() == 1 and panels["latest"].first().pair == "CLICK"
    assert 0 < panels["candles"].count() == panels["orderflow"].count() == panels["trades"].count()


def test_nightly_checks_fail_on_duplicates(spark):
    lake = scratch_path(spark, "j-lake")
    write_lake(with_redelivery(load_trades(spark, SMOKE_DIR)), lake)
    with pytest.raises(quality.QualityCheckFailed):
        jobs.nightly_checks(spark, lake, db="marts_none")


def test_cli_refresh_and_report(spark, capsys):
    from ticklake.__main__ import main

    lake, marts_root = scratch_path(spark, "c-lake"), scratch_path(spark, "c-marts")
    write_lake(load_trades(spark, SMOKE_DIR), lake)
    assert main(["refresh", "--lake", lake, "--marts", marts_root, "--as-of", "2024-01-01 01:10:00"]) == 0
    assert "fct_candles_1m" in capsys.readouterr().out
    assert main(["report"]) == 0
    assert "Newest candle minutes" in capsys.readouterr().out


def test_migrate_unkeyed(spark, tmp_path):
    import os

    import pandas as pd
    import pyarrow as pa
    import pyarrow.parquet as pq

    from ticklake.sources.lake import partition_dir, read_lake

    src = str(tmp_path / "old")
    t = load_trades(spark, SMOKE_DIR).toPandas()
    when = pd.to_datetime(t.trade_ts, unit="ms")
    t = t.assign(_d=when.dt.strftime("%Y-%m-%d"), _h=when.dt.strftime("%H"))
    for (sym, day, hh), g in t.groupby(["symbol", "_d", "_h"]):
        d = partition_dir(src, "trades", sym, day, hh)
        os.makedirs(d, exist_ok=True)
        pq.write_table(pa.Table.from_pandas(g.drop(columns=["_d", "_h"]), preserve_index=False),
                       os.path.join(d, "part-0.parquet"))
    dst = scratch_path(spark, "m-lake")
    jobs.migrate_unkeyed(spark, src, dst)
    assert read_lake(spark, dst).count() == 1000


def test_incremental_refresh_equals_full(spark):
    from conftest import M, trades_df

    from ticklake.plans.refresh import read_mart

    day = 86_400_000
    first = [("A", 1, M + 1000, 10, 1, False), ("A", 2, M + 61_000, 11, 2, True),
             ("B", 3, M + day + 5000, 20, 1, False)]
    later = [("A", 4, M + 2 * day + 7000, 12, 1, True),   # new date
             ("A", 5, M + 30_000, 9, 3, False),            # late trade on day 1
             ("C", 6, M + 2 * day + 9000, 5, 1, True)]
    as_of = "2024-01-03 00:03:00"
    lake, inc, full_lake, full = (scratch_path(spark, n) for n in ("i-lake", "i-marts", "f-lake", "f-marts"))
    write_lake(trades_df(spark, first), lake)
    jobs.refresh_marts(spark, lake, inc, as_of="2024-01-02 00:10:00", db=None)
    write_lake(trades_df(spark, later), lake)
    paths = jobs.refresh_dates(spark, lake, inc, ["2024-01-01", "2024-01-03"], as_of=as_of)
    write_lake(trades_df(spark, first + later), full_lake)
    jobs.refresh_marts(spark, full_lake, full, as_of=as_of, db=None)
    for name, path in paths.items():
        got = sorted(map(tuple, read_mart(spark, path).collect()))
        want = sorted(map(tuple, read_mart(spark, f"{full}/{name}").collect()))
        assert got == want, name


def test_catalog_follows_incremental_refresh(spark):
    """Tables read before a new date was refreshed show it afterwards."""
    from conftest import M, trades_df

    from ticklake.schema import MART_COLUMNS

    day, db = 86_400_000, "marts_follow"
    lake, root = scratch_path(spark, "k-lake"), scratch_path(spark, "k-marts")
    write_lake(trades_df(spark, [("A", 1, M + 1000, 10, 1, False)]), lake)
    jobs.refresh_marts(spark, lake, root, as_of="2024-01-01 00:10:00", db=db)
    before = {n: spark.table(f"{db}.{n}").count() for n in MART_COLUMNS}
    write_lake(trades_df(spark, [("B", 2, M + day, 10, 1, False), ("A", 3, M + day, 10, 1, False)]), lake)
    jobs.refresh_dates(spark, lake, root, ["2024-01-02"], as_of="2024-01-02 00:01:00", db=db)
    after = {n: spark.table(f"{db}.{n}").count() for n in MART_COLUMNS}
    assert set(before.values()) == {1} and after == {n: 2 if "health" in n else 3 for n in MART_COLUMNS}
    rep = jobs.report(spark, db)
    assert [df.columns for df in rep.values()][0] == list(MART_COLUMNS["fct_candles_1m"])
    assert jobs.nightly_checks(spark, lake, db=db).where("failures > 0").count() == 0


def test_full_rebuild_drops_vanished_dates(spark):
    from conftest import M, trades_df

    root, day = scratch_path(spark, "v-marts"), 86_400_000
    two, one = scratch_path(spark, "v-lake"), scratch_path(spark, "v-lake")
    write_lake(trades_df(spark, [("A", 1, M, 10, 1, False), ("A", 2, M + day, 10, 1, False)]), two)
    write_lake(trades_df(spark, [("A", 2, M + day, 10, 1, False)]), one)
    for lake, dates in ((two, 2), (one, 1)):
        path = jobs.refresh_marts(spark, lake, root, as_of="2024-01-02 00:10:00", db=None)["fct_candles_1m"]
        assert spark.read.parquet(path).select("trade_date").distinct().count() == dates


def test_deduped_refresh_counts_once(spark):
    lake, root = scratch_path(spark, "d-lake"), scratch_path(spark, "d-marts")
    t = load_trades(spark, SMOKE_DIR)
    write_lake(with_redelivery(t), lake)
    path = jobs.refresh_marts(spark, lake, root, as_of="2024-01-01 01:10:00", db=None, dedupe=True)["fct_trades_1m"]
    assert spark.read.parquet(path).agg({"trade_count": "sum"}).first()[0] == t.count()


def test_no_local_checkpoint_folder_on_a_cluster(monkeypatch):
    from ticklake import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        session.checkpoint_dir(Session())


# -- refresh from partials ------------------------------------------------------


def _rows_of(spark, root, names=None):
    return {n: sorted(map(str, read_mart(spark, f"{root}/{n}").collect())) for n in names or ALL_MARTS}


def _batches():
    """Two days, two pairs, late trades, equal times, a missing ingest time."""
    day = 86_400_000
    rows = [[(p, 100 * b + i, M + (i * 7919 + b * 13) % 600_000 + day * (i % 5 == 0), 10.25 + i % 7, 1 + i % 3, i % 2 == 0)
             for i in range(60) for p in "AB"] for b in range(5)]
    return [*rows, [("C", 1, M + day, 5, 1, True)], [], [("A", 9999, M, 1, 1, False)]]


def test_merged_refresh_equals_a_full_rebuild(spark, monkeypatch):
    monkeypatch.setattr(partials, "FOLD_BATCHES", 2)
    part, merged, full, lake = (scratch_path(spark, n) for n in ("t-partials", "t-merged", "t-full", "t-lake"))
    as_of = "2024-01-02 00:05:30"
    every = []
    for b, rows in enumerate(_batches()):
        trades = trades_df(spark, rows, ingested=["junk" if r[1] % 50 == 7 else iso(r[2] + r[1] % 9 * 1000 + 40) for r in rows])
        every += [trades]
        partials.refresh_merged(trades, part, merged, b, as_of=as_of)
        if b in (1, 3):  # a replay of the batch changes nothing
            partials.refresh_merged(trades, part, merged, b, as_of=as_of)
        partials.fold(spark, part, ["2024-01-01", "2024-01-02"], b, most=2)
    for t in every:
        if t.count():
            write_lake(t, lake)
    jobs.refresh_marts(spark, lake, full, as_of=as_of, db=None)
    assert _rows_of(spark, merged) == _rows_of(spark, full)
    at = spark.read.parquet(f"{part}/minutes")
    assert at.where("trade_date = '2024-01-01'").select("batch").distinct().count() <= 3
    minutes = at.groupBy("pair", "minute_bucket", "_lat").count()
    assert at.count() <= 3 * minutes.count()


def test_merged_refresh_reads_no_landed_trade(spark):
    part, marts = scratch_path(spark, "t-partials"), scratch_path(spark, "t-merged")
    first = trades_df(spark, [("A", i, M + i * 1000, 1, 1, False) for i in range(50)])
    partials.refresh_merged(first, part, marts, 0, as_of="2024-01-01 00:02:00")
    stored = spark.read.parquet(f"{part}/minutes")
    assert "trade_id" not in stored.columns and stored.count() == 1  # one minute, one latency
    partials.refresh_merged(trades_df(spark, [("A", 99, M, 3, 1, False)]), part, marts, 1, as_of="2024-01-01 00:02:00")
    (r,) = read_mart(spark, f"{marts}/fct_candles_1m").collect()
    assert (r.trade_count, r.high_price, r.open_price, r.close_price) == (51, 3.0, 1.0, 1.0)


def test_a_fold_that_stopped_half_way_is_finished(spark, monkeypatch):
    part, marts = scratch_path(spark, "t-partials"), scratch_path(spark, "t-merged")
    one = lambda i: trades_df(spark, [("A", i, M + i, 1, 1, False)])
    for b in range(3):
        partials.refresh_merged(one(b), part, marts, b, as_of="2024-01-01 00:02:00")
    monkeypatch.setattr(files, "apply", lambda *a: 0)  # the process dies after the commit
    partials.fold(spark, part, ["2024-01-01"], 3, most=1)
    monkeypatch.undo()
    partials.refresh_merged(one(3), part, marts, 3, as_of="2024-01-01 00:02:00")
    assert read_mart(spark, f"{marts}/fct_trades_1m").first().trade_count == 4
    assert spark.read.parquet(f"{part}/minutes").count() == 2  # the folded row and the new one
