"""Marts vs brute-force Python on random small fixtures (hypothesis)."""

from __future__ import annotations

import math
from collections import defaultdict

from conftest import M, iso, stg_of
from hypothesis import given, settings
from hypothesis import strategies as st

from ticklake.operators import marts

trade = st.tuples(
    st.sampled_from(["A", "B"]),
    st.integers(0, 179_999),                      # ms within 3 minutes
    st.sampled_from([1.0, 2.5, 10.0, 99.99]),     # price
    st.sampled_from([0.0, 1.0, 2.0, 0.5]),        # qty (zero allowed)
    st.sampled_from([True, False, None]),         # maker flag
    st.integers(-3000, 9000),                     # ingest delay ms
)


def _rows(draw):
    return [(sym, i + 1, M + off, p, q, f) for i, (sym, off, p, q, f, _) in enumerate(draw)]


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


@settings(max_examples=15, deadline=None)
@given(st.lists(trade, min_size=1, max_size=40))
def test_candles_orderflow_brute_force(spark_hyp, draw):
    rows = _rows(draw)
    stg = stg_of(spark_hyp, rows)
    groups = defaultdict(list)
    for sym, tid, ts, p, q, f in rows:
        groups[(sym, (ts - M) // 60_000)].append((ts, tid, p, q, f))
    got_c = {(r.pair, int((r.minute_bucket.timestamp() * 1000 - M) // 60_000)): r
             for r in marts.fct_candles_1m(stg).collect()}
    got_o = {(r.pair, int((r.minute_bucket.timestamp() * 1000 - M) // 60_000)): r
             for r in marts.fct_orderflow_1m(stg).collect()}
    assert set(got_c) == set(groups) == set(got_o)
    for key, g in groups.items():
        g.sort(key=lambda x: (x[0], x[1]))
        c, o = got_c[key], got_o[key]
        qty = sum(x[3] for x in g)
        notional = sum(x[2] * x[3] for x in g)
        assert (c.open_price, c.close_price) == (g[0][2], g[-1][2])
        assert (c.low_price, c.high_price, c.trade_count) == (min(x[2] for x in g), max(x[2] for x in g), len(g))
        assert _close(c.vwap, notional / qty if qty else None)
        buy = sum(x[3] for x in g if x[4] is False)
        sell = sum(x[3] for x in g if x[4] is True)
        assert _close(o.buy_qty, buy) and _close(o.sell_qty, sell)
        assert _close(o.buy_qty_ratio, buy / qty if qty else None)


@settings(max_examples=10, deadline=None)
@given(st.lists(trade, min_size=1, max_size=40))
def test_latency_brute_force(spark_hyp, draw):
    rows = _rows(draw)
    ingested = [iso(M + off + d) for (_, off, _, _, _, d) in draw]
    stg = stg_of(spark_hyp, rows, ingested=ingested)
    groups = defaultdict(list)
    for (sym, tid, ts, *_), (*_, d) in zip(rows, draw):
        sec = ts // 1000 * 1000                  # trade time at whole seconds
        lat = int((ts + d - sec) / 1000)         # truncated toward zero
        groups[(sym, (ts - M) // 60_000)].append(lat)
    got = {(r.pair, int((r.minute_bucket.timestamp() * 1000 - M) // 60_000)): r
           for r in marts.fct_ingestion_latency_1m(stg).collect()}
    assert set(got) == set(groups)
    for key, lats in groups.items():
        r, xs = got[key], sorted(lats)
        pos = 0.95 * (len(xs) - 1)
        lo, hi = math.floor(pos), math.ceil(pos)
        p95 = xs[lo] + (xs[hi] - xs[lo]) * (pos - lo)
        assert (r.trade_count, r.min_latency_s, r.max_latency_s) == (len(xs), xs[0], xs[-1])
        assert _close(r.avg_latency_s, sum(xs) / len(xs)) and _close(r.p95_latency_s, p95)
