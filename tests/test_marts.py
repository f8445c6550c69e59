"""Micro fixtures for staging and the five marts (expected rows are literals)."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import M, iso, stg_of, trades_df
from pyspark.sql import functions as F

from ticklake.operators import marts, quality, serving, staging
from ticklake.plans.refresh import build_marts
from ticklake.schema import MART_COLUMNS


def rows_of(df, order=("pair", "minute_bucket")):
    return [r.asDict() for r in df.orderBy(*[c for c in order if c in df.columns]).collect()]


def ts(ms):
    return dt.datetime.fromtimestamp(ms // 1000, dt.timezone.utc).replace(tzinfo=None)


def test_ohlc_basic(spark):
    stg = stg_of(spark, [
        ("A", 1, M, 10, 1, False), ("A", 2, M + 20000, 12, 2, True),
        ("A", 3, M + 59999, 11, 1, False), ("A", 4, M + 60000, 9, 1, True),
    ])
    out = rows_of(marts.fct_candles_1m(stg))
    assert len(out) == 2
    b1 = out[0]
    assert (b1["open_price"], b1["high_price"], b1["low_price"], b1["close_price"]) == (10, 12, 10, 11)
    assert b1["vwap"] == pytest.approx(11.25)
    assert b1["trade_count"] == 3 and b1["total_qty"] == 4 and b1["notional_usdt"] == 45
    assert out[1]["trade_count"] == 1 and out[1]["open_price"] == 9


def test_tie_same_second_uses_ms_then_trade_id(spark):
    stg = stg_of(spark, [("A", 2, M + 100, 20, 1, False), ("A", 1, M + 100, 10, 1, False),
                         ("A", 3, M + 900, 30, 1, False)])
    (row,) = rows_of(marts.fct_candles_1m(stg))
    assert row["open_price"] == 10 and row["close_price"] == 30


def test_zero_qty_bucket_gives_null_ratios(spark):
    stg = stg_of(spark, [("A", 1, M, 10, 0, False)])
    (c,) = rows_of(marts.fct_candles_1m(stg))
    assert c["vwap"] is None
    (o,) = rows_of(marts.fct_orderflow_1m(stg))
    assert [o[k] for k in ("buy_qty_ratio", "sell_qty_ratio", "buy_notional_ratio", "sell_notional_ratio")] == [None] * 4


def test_one_sided_flow(spark):
    (o,) = rows_of(marts.fct_orderflow_1m(stg_of(spark, [("A", 1, M, 10, 2, False)])))
    assert o["sell_qty"] == 0.0 and o["buy_qty_ratio"] == 1 and o["qty_imbalance"] == 2


def test_null_maker_flag_counts_in_totals_only(spark):
    (o,) = rows_of(marts.fct_orderflow_1m(stg_of(spark, [("A", 1, M, 10, 2, None)])))
    assert (o["total_qty"], o["buy_qty"], o["sell_qty"]) == (2, 0, 0)


def test_trades_mart_values(spark):
    stg = stg_of(spark, [("A", 1, M, 10, 1, False), ("A", 2, M + 1000, 20, 3, True), ("B", 3, M, 5, 1, True)])
    out = rows_of(marts.fct_trades_1m(stg))
    a = out[0]
    assert (a["pair"], a["trade_count"], a["total_qty"], a["notional_usdt"]) == ("A", 2, 4, 70)
    assert (a["avg_price"], a["min_price"], a["max_price"]) == (15, 10, 20)
    assert out[1]["pair"] == "B"


def test_latency_percentiles(spark):
    rows = [("A", i, M, 10, 1, False) for i in (1, 2, 3)]
    stg = stg_of(spark, rows, ingested=[iso(M + 1000), iso(M + 2000), iso(M + 10000)])
    (r,) = rows_of(marts.fct_ingestion_latency_1m(stg))
    assert r["p95_latency_s"] == pytest.approx(9.2)
    assert r["avg_latency_s"] == pytest.approx(13 / 3)
    assert (r["min_latency_s"], r["max_latency_s"], r["trade_count"]) == (1, 10, 3)


def test_latency_negative_truncates_toward_zero(spark):
    rows = [("A", 1, M + 5000, 10, 1, False), ("A", 2, M + 5000, 10, 1, False)]
    stg = stg_of(spark, rows, ingested=[iso(M + 5000 - 1900), iso(M + 5000 + 1900)])
    (r,) = rows_of(marts.fct_ingestion_latency_1m(stg))
    assert (r["min_latency_s"], r["max_latency_s"]) == (-1, 1)


def test_latency_skips_unparseable_ingest(spark):
    stg = stg_of(spark, [("A", 1, M, 10, 1, False)], ingested=["junk"])
    assert marts.fct_ingestion_latency_1m(stg).count() == 0
    assert marts.fct_candles_1m(stg).count() == 1


def test_health_window_includes_boundary_and_future(spark):
    as_of = M + 3600_000
    rows = [("A", 1, as_of, 1, 1, False), ("A", 2, as_of - 300_000, 1, 1, False),
            ("A", 3, as_of - 301_000, 1, 1, False), ("A", 4, as_of + 10_000, 1, 1, False)]
    (h,) = rows_of(marts.fct_pipeline_health_5m(stg_of(spark, rows), as_of=ts(as_of)), ("pair",))
    assert h["trades_last_5m"] == 3
    assert h["max_trade_ts_utc"] == ts(as_of + 10_000)
    assert h["seconds_since_last_trade"] == -10


def test_health_none_recent_is_zero(spark):
    (h,) = rows_of(marts.fct_pipeline_health_5m(stg_of(spark, [("A", 1, M, 1, 1, False)]),
                                                as_of=ts(M + 86_400_000)), ("pair",))
    assert h["trades_last_5m"] == 0
    assert h["seconds_since_last_trade"] == 86_400


def test_health_from_minute_stats_equals_direct(spark):
    rows = [("A", i, M + i * 7000, 1, 1, False) for i in range(100)] + [("B", 500, M, 1, 1, True)]
    stg = stg_of(spark, rows)
    as_of = ts(M + 600_000)
    direct = rows_of(marts.fct_pipeline_health_5m(stg, as_of=as_of), ("pair",))
    rolled = rows_of(build_marts(stg, as_of=as_of)["fct_pipeline_health_5m"], ("pair",))
    assert direct == rolled


def test_iso_forms_keep_micros(spark):
    stg = stg_of(spark, [("A", i, M, 1, 1, False) for i in (1, 2, 3)], ingested=[
        "2024-01-01T10:00:00.123456+00:00", "2024-01-01T10:00:00+00:00", "2024-01-01T10:00:00.5"])
    got = sorted(r[0] for r in stg.select("ingested_at_utc").collect())
    assert got == [dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 10, 0, 0, 123456),
                   dt.datetime(2024, 1, 1, 10, 0, 0, 500000)]


def test_hour_edge_is_utc(spark):
    edge = M + 86_400_000
    stg = stg_of(spark, [("A", 1, edge - 1, 1, 1, False), ("A", 2, edge, 1, 1, False)])
    got = sorted((r.trade_id, str(r.trade_date), r.hour) for r in stg.collect())
    assert got == [(1, "2024-01-01", 23), (2, "2024-01-02", 0)]


def test_staging_contract_columns(spark):
    stg = stg_of(spark, [("btc", 7, M + 1500, 1, 1, True)])
    r = stg.collect()[0]
    assert r.trade_key == "btc:7" and r.is_buyer_maker == 1 and r.trade_ts_utc == ts(M + 1000)
    assert staging.contract_columns(stg).columns[:3] == ["pair", "trade_date", "hour"]


def test_empty_input_keeps_schemas(spark):
    empty = stg_of(spark, [("A", 1, M, 1, 1, False)]).limit(0)
    for name, build in marts.MART_BUILDERS.items():
        df = build(empty)
        assert df.count() == 0
        assert list(df.columns) == list(MART_COLUMNS[name])
    pairs = serving.list_pairs(marts.fct_candles_1m(empty)).collect()
    assert [r.pair for r in pairs] == ["BTCUSDT"]


def test_list_pairs_no_fallback_when_present(spark):
    c = marts.fct_candles_1m(stg_of(spark, [("B", 1, M, 1, 1, False), ("A", 2, M, 1, 1, False)]))
    assert [r.pair for r in serving.list_pairs(c).collect()] == ["A", "B"]


def test_duplicate_delivery(spark):
    t = trades_df(spark, [("A", 1, M, 10, 1, False), ("A", 1, M, 10, 1, False)],
                  ingested=[iso(M + 2000), iso(M + 1000)])
    stg = staging.stg_trades(t)
    assert [tuple(r) for r in quality.unique(stg, "stg_trades", "trade_key").collect()] == \
        [("stg_trades", "trade_key", "unique", 1)]
    d = staging.dedupe_trades(stg).collect()
    assert len(d) == 1 and d[0].ingested_at_utc == ts(M + 1000)


def test_not_null_violation(spark):
    stg = stg_of(spark, [("A", 1, M, 10, 1, False), ("A", 2, M, 10, 1, False)]).withColumn(
        "price", F.when(F.col("trade_id") == 2, None).otherwise(F.col("price")))
    checks = quality.run_checks({"stg_trades": stg})
    failing = [tuple(r) for r in checks.where("failures > 0").collect()]
    assert failing == [("stg_trades", "price", "not_null", 1)]
    with pytest.raises(quality.QualityCheckFailed):
        quality.assert_passed(checks)


def test_candle_invariants(spark):
    from conftest import SMOKE_DIR

    from ticklake.sources.testdata import load_trades

    c = marts.fct_candles_1m(staging.stg_trades(load_trades(spark, SMOKE_DIR)))
    bad = c.where("low_price > open_price OR low_price > close_price OR high_price < open_price "
                  "OR high_price < close_price OR vwap < low_price - 1e-9 OR vwap > high_price + 1e-9")
    assert bad.count() == 0


def test_orderflow_invariants(spark):
    from conftest import SMOKE_DIR

    from ticklake.sources.testdata import load_trades

    o = marts.fct_orderflow_1m(staging.stg_trades(load_trades(spark, SMOKE_DIR)))
    bad = o.where("abs(buy_qty + sell_qty - total_qty) > 1e-6 "
                  "OR (total_qty > 0 AND abs(buy_qty_ratio + sell_qty_ratio - 1) > 1e-9)")
    assert bad.count() == 0


def test_bucket_width_parameter(spark):
    rows = [("A", i, M + i * 60_000, 10 + i, 1, False) for i in range(10)]
    c5 = rows_of(marts.fct_candles_1m(stg_of(spark, rows), bucket="5 minutes"))
    assert [(r["trade_count"], r["open_price"], r["close_price"]) for r in c5] == [(5, 10, 14), (5, 15, 19)]
    lat = rows_of(marts.fct_ingestion_latency_1m(stg_of(spark, rows), bucket="5 minutes"))
    assert [r["trade_count"] for r in lat] == [5, 5]


def test_health_lookback_parameter(spark):
    rows = [("A", 1, M, 1, 1, False), ("A", 2, M + 600_000, 1, 1, False)]
    (h,) = rows_of(marts.fct_pipeline_health_5m(stg_of(spark, rows), as_of=ts(M + 900_000),
                                                lookback="15 minutes"), ("pair",))
    assert h["trades_last_5m"] == 2


def test_sql_on_staging_view_group_by_ordinal(spark):
    from ticklake.sources.catalog import create_view
    from ticklake.sources.testdata import load_trades
    from conftest import SMOKE_DIR

    stg = staging.stg_trades(load_trades(spark, SMOKE_DIR))
    create_view(stg, "stg_trades_sql")
    sql = spark.sql("""
        SELECT pair, date_trunc('MINUTE', trade_ts_utc) AS minute_bucket,
               count(*) AS trade_count, sum(qty) AS total_qty, sum(price * qty) AS notional_usdt,
               avg(price) AS avg_price, min(price) AS min_price, max(price) AS max_price
        FROM stg_trades_sql WHERE trade_ts_utc IS NOT NULL
        GROUP BY 1, 2""")
    def rounded(d):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in d.collect())

    want = rounded(marts.fct_trades_1m(stg))
    assert rounded(sql) == want and len(want) > 0


def test_aggregate_forms_equal_window_forms(spark):
    from conftest import SMOKE_DIR

    from ticklake.plans import registry as Q

    pairs = [("fct_candles_1m", "candles_window_join_form"),
             ("fct_ingestion_latency_1m", "latency_window_distinct_form")]
    for agg_form, window_form in pairs:
        a = Q.QUERIES[agg_form](spark, SMOKE_DIR)
        w = Q.QUERIES[window_form](spark, SMOKE_DIR).select(*a.columns)
        got, want = sorted(map(tuple, w.collect())), sorted(map(tuple, a.collect()))
        assert got == want and len(want) > 0, agg_form


def test_dlq_rate_of_checked_records(spark):
    """One pass gives what the two stored sides give; times that are missing count nowhere."""
    from ticklake.operators import ingest
    from ticklake.sources.testdata import kafka_records

    checked = ingest.check_contract(kafka_records(trades_df(spark, [("A", i, M + i * 20_000, 1, 1, False) for i in range(200)])), metrics_name=None)
    two = quality.dlq_rate(staging.stg_trades(ingest.good_rows(checked)), ingest.to_dlq(ingest.bad_rows(checked)), interval="10 minutes")
    one = quality.dlq_rate_of(checked, "10 minutes")
    assert one.columns == two.columns and sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    assert one.agg(F.sum(F.col("landed") + F.col("dead_lettered"))).first()[0] == 200
    assert one._jdf.queryExecution().optimizedPlan().toString().count("parse_json") <= 1


def test_first_last_equals_row_number(spark):
    """One row per group, one of the tied ones, where the flag form marks them all."""
    from pyspark.sql import Window

    from ticklake.operators import windows

    rows = [("A", 1, 10.0), ("A", 1, 11.0), ("A", 2, 12.0), ("A", None, 1.0), ("B", None, 5.0), ("C", 3, None), ("C", 4, 6.0)]
    df = spark.createDataFrame(rows, "pair string, k long, price double")
    got = {r.pair: (r.o, r.c) for r in windows.first_last(df, ["pair"], F.col("k"), "price", "o", "c").collect()}
    w = Window.partitionBy("pair")
    numbered = df.select("*", F.row_number().over(w.orderBy(F.asc_nulls_last("k"), "price")).alias("a"),
                         F.row_number().over(w.orderBy(F.desc_nulls_last("k"), "price")).alias("d"))
    want = {r.pair: (r.o, r.c) for r in numbered.groupBy("pair").agg(
        F.max(F.when(F.col("a") == 1, F.col("price"))).alias("o"), F.max(F.when(F.col("d") == 1, F.col("price"))).alias("c")).collect()}
    assert got["A"][0] in (10.0, 11.0) and got["A"][1] == want["A"][1] == 12.0
    assert {k: got[k] for k in "BC"} == {k: want[k] for k in "BC"} == {"B": (5.0, 5.0), "C": (None, 6.0)}
    plan = windows.first_last(df, ["pair"], F.col("k"), "price", "o", "c")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1 and "SortAggregate" not in plan
