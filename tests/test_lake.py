"""Lake layout, range reads, external table, compaction, catalog, snapshots, refresh."""

from __future__ import annotations

import glob
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import M, SMOKE_DIR, stg_of, trades_df
from pyspark.sql import functions as F

from ticklake.operators import marts, serving
from ticklake.plans import compaction
from ticklake.plans import refresh as R
from ticklake.plans.compaction import compact
from ticklake.plans.snapshot import append_snapshot, read_as_of
from ticklake.schema import TRADE_V1
from ticklake.session import local_path, scratch_path
from ticklake.sources import catalog, files, plain
from ticklake.sources.lake import create_external_table, partition_dir, read_lake, read_unkeyed, write_lake
from ticklake.sources.testdata import load_trades

HOUR = 3_600_000


def _files(root):
    found = glob.glob(os.path.join(local_path(root), "**", "*.parquet"), recursive=True)
    return [f for f in found if "/_swaps/" not in f]


def test_keyed_layout_and_roundtrip(spark):
    root = scratch_path(spark, "t-lake")
    t = trades_df(spark, [("btcusdt", 1, M, 1, 1, False), ("ETHUSDT", 2, M + HOUR, 2, 1, True)])
    write_lake(t, root)
    dirs = sorted(os.path.relpath(os.path.dirname(f), local_path(root)) for f in _files(root))
    assert dirs == ["pair=BTCUSDT/trade_date=2024-01-01/hour=0", "pair=ETHUSDT/trade_date=2024-01-01/hour=1"]
    back = read_lake(spark, root)
    assert dict(back.dtypes)["hour"] == "tinyint" and dict(back.dtypes)["trade_date"] == "date"
    assert back.count() == 2


def test_range_read_prunes_partitions(spark):
    root = scratch_path(spark, "t-lake")
    write_lake(trades_df(spark, [("A", i, M + i * HOUR // 2, 1, 1, False) for i in range(8)]), root)
    df = read_lake(spark, root, start="2024-01-01 01:00:00", end="2024-01-01 02:00:00")
    assert sorted(r.trade_id for r in df.collect()) == [2, 3]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "hour" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_unkeyed_layout_reader(spark, tmp_path):
    root = str(tmp_path / "bucket")
    t = pa.table({f.name: pa.array([v], type={
        "LongType()": pa.int64(), "StringType()": pa.string(), "DoubleType()": pa.float64(),
        "BooleanType()": pa.bool_()}[repr(f.dataType)]) for f, v in zip(TRADE_V1.fields, [
            1, "e", "s", "2024-01-01T10:00:00+00:00", "BTCUSDT", 9, M + 10 * HOUR, 1.0, 2.0, True])})
    d = partition_dir(root, "trades", "BTCUSDT", "2024-01-01", "10")
    os.makedirs(d)
    pq.write_table(t, os.path.join(d, "part-x.parquet"), compression="zstd")
    (r,) = read_unkeyed(spark, root).collect()
    assert (r.pair, str(r.trade_date), r.hour, r.trade_id) == ("BTCUSDT", "2024-01-01", 10, 9)
    assert r.location.endswith("/trades/BTCUSDT/2024-01-01/10/part-x.parquet")


def test_external_table_idempotent(spark):
    root = scratch_path(spark, "t-lake")
    write_lake(load_trades(spark, SMOKE_DIR), root)
    catalog.ensure_namespaces(spark, ["ext"], location_root=scratch_path(spark, "t-cat"))
    for _ in range(2):
        name = create_external_table(spark, root, "ext", "trades_t")
        assert spark.table(name).count() == 1000
    assert ("trades_t", "EXTERNAL") in catalog.list_tables(spark, "ext")


def test_compaction_reduces_files(spark):
    root = scratch_path(spark, "t-lake")
    rows = [("A", i, M + (i % 4) * 60_000, 1, 1, False) for i in range(40)]
    for k in range(4):
        write_lake(trades_df(spark, rows[k * 10:(k + 1) * 10]), root, num_partitions=2)
    before = len(_files(root))
    compact(spark, root, ["2024-01-01"])
    after = _files(root)
    assert before > len(after) == 1
    assert sorted(r.trade_id for r in read_lake(spark, root).collect()) == list(range(40))


def _small_lake(spark, batches=4):
    root = scratch_path(spark, "t-lake")
    for k in range(batches):
        write_lake(trades_df(spark, [(p, 10 * k + i, M + i * HOUR // 2, 1, 1, False) for p in "AB" for i in range(4)]), root)
    return root


def _ids(spark, root):
    return sorted((r.pair, r.trade_id) for r in read_lake(spark, root).collect())


def test_compaction_keeps_concurrent_appends_and_other_files(spark):
    root = _small_lake(spark)
    write_lake(trades_df(spark, [("C", 1, M, 1, 1, False)]), root)  # a directory with a single file
    alone, before = [f for f in _files(root) if "pair=C" in f], _ids(spark, root)
    staged = compaction.stage_compaction(spark, root)
    assert _ids(spark, root) == before and staged.files == len(_files(root)) - 1
    write_lake(trades_df(spark, [("A", 99, M, 1, 1, False)]), root)
    files.apply(spark, staged.swap)
    assert _ids(spark, root) == sorted([*before, ("A", 99)])
    assert [f for f in _files(root) if "pair=C" in f] == alone
    assert compact(spark, root, ["1999-01-01"]) == compaction.Staged(None, 0, 0)
    assert compact(spark, root).files == 2  # the merged file and the one appended beside it
    assert _ids(spark, root) == sorted([*before, ("A", 99)])


@pytest.mark.parametrize("done", [0, 1, 2])
def test_compaction_survives_a_crash(spark, monkeypatch, done):
    """The swap stops after some file operations; the next run finishes it."""
    root = _small_lake(spark)
    before = _ids(spark, root)
    staged = compaction.stage_compaction(spark, root)
    rows = spark.read.parquet(f"{staged.swap}/journal").orderBy("place").collect()
    strip = lambda p: p.replace("file:", "")
    for row in rows[:done]:  # what a crash can leave: entries done, half done, not begun
        os.rename(strip(row.new[0]), strip(row.place[0]))
        os.remove(strip(row.old[0]))
    assert files.recover(spark, root) == len(rows)
    assert _ids(spark, root) == before and len(_files(root)) == len(rows)
    assert files.recover(spark, root) == 0


def test_compaction_drops_an_entry_that_was_overtaken(spark):
    root = _small_lake(spark)
    staged = compaction.stage_compaction(spark, root)
    write_lake(trades_df(spark, [("A", 7, M, 1, 1, False)]), root, mode="overwrite")  # a new lake
    if os.path.exists(staged.swap.replace("file:", "")):
        files.apply(spark, staged.swap)
    assert _ids(spark, root) == [("A", 7)]


def test_first_fit():
    assert compaction.first_fit([5, 4, 3, 3, 1], 8) == [0, 1, 0, 1, 1]
    assert compaction.first_fit([9, 1], 8) == [0, 1] and compaction.first_fit([], 8) == []


def _plain(spark, root, pair="A", hour="01", ids=(1,)):
    at = partition_dir(root, "trades", pair, "2024-01-01", hour)
    trades_df(spark, [(pair, i, M + int(hour) * HOUR, 1.5, 1, False) for i in ids]).write.mode("append").parquet(at)


def test_plain_table_prunes_and_follows_the_tree(spark, tmp_path):
    root = str(tmp_path / "plain")
    _plain(spark, root, "A", "01")
    _plain(spark, root, "it's", "02", (2, 3))
    os.makedirs(f"{root}/trades/A/notes/01")
    name = plain.create_plain_table(spark, root, db="ext_t", name="plain_t")
    assert spark.table(name).count() == 3
    one = spark.table(name).where("pair = \"it's\" and hour >= 2")
    assert sorted(r.trade_id for r in one.collect()) == [2, 3]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pair" in plan.replace("\n", " ") and len(one.inputFiles()) >= 1
    assert all("it" in f for f in one.inputFiles())
    _plain(spark, root, "A", "01", (4,))
    _plain(spark, root, "B", "23", (5,))
    assert plain.sync_plain_table(spark, name, root) == (1, 0)
    assert spark.table(name).count() == 5
    os.rename(f"{root}/trades/B", f"{root}/B")
    assert plain.sync_plain_table(spark, name, root) == (0, 1)
    assert spark.table(name).count() == 4


def test_drifted_files_of_several_kinds(spark, tmp_path):
    root = str(tmp_path / "drift")
    _plain(spark, root, "A", "01", (1,))
    at = partition_dir(root, "trades", "A", "2024-01-01", "01")
    odd = trades_df(spark, [("A", 2, M, 7, 1, False), ("A", 3, M, 8, 1, False)])
    odd.withColumn("price", F.lit(7)).withColumn("more", F.lit(1)).write.mode("append").parquet(at)
    odd.drop("qty").withColumn("price", F.when(F.col("trade_id") == 2, "2.5").otherwise("junk")).write.mode("append").parquet(at)
    rows = plain.read_drifted(spark, root).collect()
    got = sorted((r.trade_id, r.price is None, r.price or 0, r.qty is None, r.hour) for r in rows)
    assert got == [(1, False, 1.5, False, 1), (2, False, 2.5, True, 1), (2, False, 7.0, False, 1), (3, False, 7.0, False, 1), (3, True, 0, True, 1)]
    os.makedirs(tmp_path / "none" / "trades")
    assert plain.read_drifted(spark, str(tmp_path / "none")).collect() == []


def test_staging_view_is_persistent_and_prunes(spark):
    from ticklake.operators.staging import contract_columns, stg_trades

    root = _small_lake(spark, 1)
    write_lake(trades_df(spark, [("A", 50, M, 1, 1, None)], ingested=["junk"]), root)
    name = catalog.create_staging_view(spark, create_external_table(spark, root, "ext", "for_view_t"), "stg_t.stg_trades")
    view = spark.newSession().table(name)
    want = contract_columns(stg_trades(read_lake(spark, root)))
    assert view.columns == want.columns and [t for _, t in view.dtypes] == [t for _, t in want.dtypes]
    assert sorted(map(str, view.collect())) == sorted(map(str, want.collect()))
    plan = spark.table(name).where("trade_date = date '2024-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trade_date" in plan


def test_snapshot_as_of(spark):
    path = scratch_path(spark, "t-snap")
    stg = stg_of(spark, [("A", 1, M, 10, 1, False), ("A", 2, M + HOUR, 20, 1, False)])
    early = stg.where(F.col("trade_ts_utc") < F.lit("2024-01-01 00:30:00").cast("timestamp"))
    append_snapshot(marts.fct_candles_1m(early), path, "2024-01-01 00:30:00")
    append_snapshot(marts.fct_candles_1m(stg), path, "2024-01-01 02:00:00")
    append_snapshot(marts.fct_candles_1m(stg), path, "2024-01-01 02:00:00")  # re-run: replaces
    assert read_as_of(spark, path, "2024-01-01 01:00:00").count() == 1
    assert read_as_of(spark, path, "2024-01-01 03:00:00").count() == 2
    assert read_as_of(spark, path, "2023-12-31 00:00:00").count() == 0


def test_snapshot_stores_changed_dates_only(spark):
    path, day = scratch_path(spark, "t-snap"), 24 * HOUR
    rows = [("A", 1, M, 10, 1, False), ("A", 2, M + day, 20, 1, False), ("B", 3, M + 2 * day, 30, 1, True)]
    one, two = (marts.fct_candles_1m(stg_of(spark, r)) for r in (rows, [*rows[:2], ("B", 4, M + 2 * day, 31, 2, True)]))
    assert append_snapshot(one, path, "2024-01-04 00:00:00") == 3
    held = set(_files(f"{path}/data"))
    assert append_snapshot(two, path, "2024-01-05 00:00:00") == 1  # the third date alone
    assert append_snapshot(two, path, "2024-01-06 00:00:00") == 0
    assert held < set(_files(f"{path}/data")) and len(_files(f"{path}/data")) == 4
    plan = read_as_of(spark, path, "2024-01-05 12:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan

    def as_of(t):
        return sorted(map(tuple, read_as_of(spark, path, t).select(*one.columns).collect()))

    plain = {n: sorted(map(tuple, m.collect())) for n, m in (("one", one), ("two", two))}
    assert as_of("2024-01-04 12:00:00") == plain["one"] and as_of("2024-01-05 00:00:00") == as_of("2024-01-09 00:00:00") == plain["two"]
    append_snapshot(one.where("pair = 'B'"), path, "2024-01-04 00:00:00")  # replaced; later snapshots stay as they were
    assert as_of("2024-01-04 12:00:00") == [r for r in plain["one"] if r[0] == "B"] and as_of("2024-01-05 00:00:00") == plain["two"]
    append_snapshot(one.limit(0), path, "2024-01-07 00:00:00")  # an empty mart is a snapshot, too
    assert as_of("2024-01-07 00:00:00") == [] and as_of("2024-01-06 00:00:00") == plain["two"]


def test_snapshot_of_marts_without_minutes(spark):
    path = scratch_path(spark, "t-snap")
    health = spark.createDataFrame([("A", 1), ("B", None)], "pair string, trades_last_5m int")
    assert append_snapshot(health.limit(0), path, "2024-01-01 00:00:00") == 0
    assert read_as_of(spark, path, "2024-01-02 00:00:00").count() == 0
    assert append_snapshot(health, path, "2024-01-02 00:00:00") == 1
    assert append_snapshot(health.orderBy(F.desc("pair")), path, "2024-01-03 00:00:00") == 0
    swapped = spark.createDataFrame([("A", None), ("B", 1)], health.schema)
    assert append_snapshot(swapped, path, "2024-01-04 00:00:00") == 1
    assert append_snapshot(swapped.union(swapped.where("pair = 'A'")), path, "2024-01-05 00:00:00") == 1
    counts = [read_as_of(spark, path, f"2024-01-0{d} 00:00:00").count() for d in range(1, 6)]
    assert counts == [0, 2, 2, 2, 3]


def test_health_report_is_swapped(spark, monkeypatch):
    """The report is there at every step of its replacement, and a crash after the commit is finished."""
    path = scratch_path(spark, "t-health")
    report = lambda n: spark.createDataFrame([("A", n), ("B", n)], "pair string, n int").repartition(2)
    read = lambda: sorted(map(tuple, spark.read.parquet(path).collect()))
    for n in (1, 2):
        R.materialize(report(n), path, R.HEALTH_MART)
        assert read() == [("A", n), ("B", n)]
    with monkeypatch.context() as m:
        m.setattr(files, "apply", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            R.materialize(report(3), path, R.HEALTH_MART)
        assert read() == [("A", 2), ("B", 2)]
    files.recover(spark, path)
    assert read() == [("A", 3), ("B", 3)]
    R.materialize(spark.read.parquet(path).withColumn("n", F.col("n") + 1), path, R.HEALTH_MART)  # from itself
    assert read() == [("A", 4), ("B", 4)]
    R.materialize(report(5).limit(0), path, R.HEALTH_MART)
    assert read() == []


def test_refresh_select_and_catalog(spark):
    stg = stg_of(spark, [("A", 1, M, 10, 1, False), ("B", 2, M, 20, 1, True)])
    assert R.resolve(["fct_candles_1m", "stg_trades"]) == ["fct_candles_1m"]
    with pytest.raises(ValueError):
        R.resolve(["nope"])
    root = scratch_path(spark, "t-marts")
    db = "marts_t"
    assert serving.missing_marts(spark, db) if spark.catalog.databaseExists(db) else True
    paths = R.refresh(spark, stg, root, select=["fct_candles_1m"], as_of="2024-01-01 00:10:00", db=db)
    assert list(paths) == ["fct_candles_1m"]
    assert serving.missing_marts(spark, db) == ["fct_orderflow_1m", "fct_trades_1m"]
    with pytest.raises(serving.MissingMartsError):
        serving.require_marts(spark, db)
    assert serving.health_table(spark, db) is None
    R.refresh(spark, stg, root, as_of="2024-01-01 00:03:00", db=db)
    assert serving.missing_marts(spark, db) == []
    report = serving.latest_of_each_mart(spark, db)
    assert list(report) == [t for t, _, _ in serving.REPORT]
    assert report["Newest candle minutes"].count() == 2
    h = serving.health_table(spark, db).collect()
    assert [(r.pair, r.trades_last_5m) for r in h] == [("A", 1), ("B", 1)]


def test_build_marts_shares_one_aggregate(spark):
    stg = stg_of(spark, [("A", 1, M, 10, 1, False)])
    ms = R.build_marts(stg, as_of="2024-01-01 00:10:00")
    u = None
    for df in ms.values():
        one = df.select(F.lit(1).alias("x"))
        u = one if u is None else u.unionByName(one)
    assert len(u.collect()) == 5
    plan = u._jdf.queryExecution().executedPlan().toString()
    # the five marts read one shuffled aggregate: one exchange, reused
    assert plan.count("ReusedExchange") >= 1


def test_views_and_namespaces(spark):
    made = catalog.ensure_namespaces(spark, ["ext", "stg", "marts"], location_root=scratch_path(spark, "t-cat"))
    assert made == ["ext", "stg", "marts"]
    name = catalog.create_view(stg_of(spark, [("A", 1, M, 10, 1, False)]), "stg_trades_t")
    assert spark.table(name).count() == 1
    g = catalog.create_view(stg_of(spark, [("A", 1, M, 10, 1, False)]), "stg_trades_t", db="stg")
    assert spark.table(g).count() == 1


def test_read_trades_both_layouts(spark, tmp_path):
    from ticklake.sources.lake import read_trades

    root = scratch_path(spark, "t-lake")
    write_lake(trades_df(spark, [("A", i, M + i * HOUR // 2, 1, 1, False) for i in range(4)]), root)
    assert read_trades(spark, root, start="2024-01-01 00:30:00").count() == 3
    with pytest.raises(ValueError):
        read_trades(spark, root, layout="nope")


def test_unkeyed_reader_with_drifted_types(spark, tmp_path):
    root = str(tmp_path / "drift")
    d = partition_dir(root, "trades", "BTCUSDT", "2024-01-01", "10")
    os.makedirs(d)
    t = pa.table({"schema_version": [1], "event_id": ["e"], "source": ["s"],
                  "ingested_at": ["2024-01-01T10:00:00+00:00"], "symbol": ["BTCUSDT"], "trade_id": [9],
                  "trade_ts": [M + 10 * HOUR], "price": pa.array([42], pa.int64()), "qty": pa.array([2], pa.int64()),
                  "is_buyer_maker": [True]})
    pq.write_table(t, os.path.join(d, "part-int.parquet"))
    from pyspark.sql.types import LongType, StructField, StructType

    physical = StructType([StructField(f.name, LongType(), True) if f.name in ("price", "qty") else f
                           for f in TRADE_V1.fields])
    (r,) = read_unkeyed(spark, root, schema=physical).collect()
    assert (r.price, r.qty, r.hour, r.pair) == (42.0, 2.0, 10, "BTCUSDT")
    assert isinstance(r.price, float)
