"""Physical-plan shape: one shuffle per mart, hash aggregation, pushdown."""

from __future__ import annotations

from conftest import SMOKE_DIR

from ticklake.operators import marts, serving
from ticklake.operators.staging import stg_trades
from ticklake.plans.registry import AS_OF
from ticklake.sources.testdata import load_trades


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def stg(spark):
    return stg_trades(load_trades(spark, SMOKE_DIR))


def test_candles_single_exchange_hash_aggregate(spark):
    p = plan(marts.fct_candles_1m(stg(spark)))
    assert p.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in p and p.count("HashAggregate") == 2
    assert "Window" not in p and "Join" not in p


def test_percentiles_over_counted_latencies(spark):
    for df in (marts.fct_ingestion_latency_1m(stg(spark)), marts.minute_stats(stg(spark), marts.ALL_MINUTE)):
        p = plan(df)
        # trades go through hash aggregates only; the percentile sees their counts
        assert p.count("Exchange") == 2 and "SortAggregate" not in p
        below = p[p.rindex("Exchange"):]
        assert "HashAggregate" in below and "ObjectHashAggregate" not in below and "percentile" not in below
        # p95 and p99 come from one buffer: one partial, one final percentile
        assert p.count("partial_percentile(") == 1 and p.count("percentile(") == 2


def test_stored_slice_prunes_dates(spark, tmp_path):
    from ticklake.plans.refresh import refresh
    from ticklake.session import scratch_path

    paths = refresh(spark, stg(spark), scratch_path(spark, "p-marts"), select=["fct_candles_1m"], as_of=AS_OF)
    df = serving.candles_slice(spark.read.parquet(paths["fct_candles_1m"]), "CLICK", 30, as_of=AS_OF)
    assert "trade_date" in plan(df).split("PartitionFilters: [")[1].split("]")[0]
    assert "trade_date" not in df.columns


def test_staging_filter_prunes_the_lake(spark):
    from ticklake.session import scratch_path
    from ticklake.sources.lake import read_lake, write_lake

    root = scratch_path(spark, "p-lake")
    write_lake(load_trades(spark, SMOKE_DIR), root)
    df = stg_trades(read_lake(spark, root)).where("pair = 'CLICK' and trade_date = date'2024-01-01' and hour = 0")
    filters = plan(df).split("PartitionFilters: [")[1].split("], ")[0]
    assert all(c in filters for c in ("pair", "trade_date", "hour"))


def test_scan_reads_only_needed_columns(spark):
    p = plan(marts.fct_trades_1m(stg(spark)))
    read_schema = p.split("ReadSchema: ")[1].split("\n")[0]
    assert "user_id" not in read_schema  # only the maker flag needs it


def test_slice_filter_below_aggregate(spark):
    c = marts.fct_candles_1m(stg(spark))
    p = plan(serving.candles_slice(c, "CLICK", 30, as_of=AS_OF))
    # the pair/time predicates run below the aggregate (before the
    # shuffle), not on the mart rows: the only Filter is under the exchange
    assert p.count("- Filter ") == 1
    assert p.index("- Filter ") > p.index("Exchange hashpartitioning")
    assert "upper(event_type" in p.split("- Filter ")[1].split("\n")[0]


def test_top_k_is_take_ordered(spark):
    p = plan(serving.top_n(marts.fct_trades_1m(stg(spark))))
    assert "TakeOrderedAndProject" in p


def test_health_single_small_shuffle(spark):
    p = plan(marts.fct_pipeline_health_5m(stg(spark), as_of=AS_OF))
    assert p.count("Exchange") == 1 and "HashAggregate" in p


def test_dedupe_pre_aggregates_before_shuffle(spark):
    from ticklake.operators.staging import dedupe_trades
    from ticklake.sources.testdata import with_redelivery

    df = dedupe_trades(stg_trades(with_redelivery(load_trades(spark, SMOKE_DIR))))
    p = plan(df)
    # partial aggregate (map side) -> one exchange -> final aggregate
    assert p.count("Exchange hashpartitioning") == 1
    assert "partial_min_by" in p and p.count("SortAggregate") + p.count("HashAggregate") >= 2
