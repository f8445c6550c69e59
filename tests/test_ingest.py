"""Ingest: contract check, DLQ payload, feed normalisation, partition values."""

from __future__ import annotations

import json

from conftest import M
from pyspark.sql import functions as F

from ticklake.operators import ingest
from ticklake.schema import KAFKA_RECORD

GOOD = {
    "schema_version": 1, "event_id": "u1", "source": "s", "ingested_at": "2024-01-01T00:00:01+00:00",
    "symbol": "btcusdt", "trade_id": 5, "trade_ts": M, "price": 1.5, "qty": 2.0, "is_buyer_maker": False,
}


def records(spark, payloads):
    rows = []
    for i, p in enumerate(payloads):
        if p is None:
            v = None
        elif isinstance(p, (bytes, bytearray)):
            v = bytearray(p)
        elif isinstance(p, str):
            v = bytearray(p.encode())
        else:
            v = bytearray(json.dumps(p).encode())
        rows.append((bytearray(b"k"), v, "t", i % 3, i, None))
    return spark.createDataFrame(rows, KAFKA_RECORD)


def errors(spark, payloads, mode=ingest.FULL):
    c = ingest.check_contract(records(spark, payloads), mode)
    return [r.error for r in c.orderBy("offset").collect()]


def with_(**kw):
    d = dict(GOOD)
    for k, v in kw.items():
        if v is KeyError:
            d.pop(k)
        else:
            d[k] = v
    return d


def test_good_record_typed_and_upper_cased(spark):
    (r,) = ingest.check_contract(records(spark, [GOOD])).collect()
    assert r.error is None
    assert (r.symbol, r.trade_id, r.trade_ts, r.price, r.qty, r.is_buyer_maker) == ("BTCUSDT", 5, M, 1.5, 2.0, False)


def test_bad_json_all_dead_lettered(spark):
    got = errors(spark, ["{bad", "[1]", '"x"', "5", "", None, "null"])
    assert got == ["invalid_json", "not_object", "not_object", "not_object", "invalid_json", "invalid_json",
                   "not_object"]


def test_missing_key_reports_first_in_order(spark):
    assert errors(spark, [with_(symbol=KeyError, qty=KeyError)], ingest.MINIMAL) == ["missing_key:symbol"]
    assert errors(spark, [with_(symbol=KeyError, qty=KeyError)]) == ["missing_key:symbol"]


def test_null_vs_missing(spark):
    p = [with_(symbol=None)]
    # present but null: nothing is missing, but a required value is
    for mode in (ingest.MINIMAL, ingest.FULL):
        assert errors(spark, p, mode) == ["type:symbol"]
    assert errors(spark, [with_(symbol=KeyError)], ingest.MINIMAL) == ["missing_key:symbol"]


def test_wrong_types(spark):
    p = [with_(price="1.0"), with_(trade_id=1.5), with_(trade_id=1.0), with_(is_buyer_maker=1),
         with_(trade_ts=None), with_(qty=3), with_(trade_id=True)]
    assert errors(spark, p) == ["type:price", "type:trade_id", None, "type:is_buyer_maker", "type:trade_ts",
                                None, "type:trade_id"]


def test_extra_key_passes_and_is_dropped(spark):
    c = ingest.check_contract(records(spark, [with_(venue="spot")]))
    (r,) = ingest.good_rows(c).collect()
    assert "venue" not in r.asDict()


def test_dlq_truncation_and_replacement(spark):
    max_bytes = 20
    ascii_raw = "a" * (max_bytes + 1)
    multi = "é" * 11  # 22 bytes, 11 chars
    bad_utf8 = b"ab\xffcd"
    c = ingest.check_contract(records(spark, [ascii_raw, multi, bad_utf8, None]))
    out = [json.loads(r.value) for r in ingest.to_dlq(ingest.bad_rows(c), max_bytes).orderBy("offset").collect()]
    assert out[0]["raw"] == "a" * 10 + "...<truncated>"
    assert out[1]["raw"] == "é" * 10 + "...<truncated>"
    assert out[2]["raw"] == "ab�cd"
    assert out[3]["raw"] == ""
    assert {o["schema_version"] for o in out} == {1}
    assert {o["source"] for o in out} == {"crypto-consumer"}


def test_dlq_key_is_topic_partition(spark):
    c = ingest.check_contract(records(spark, ["{bad", "{bad"]))
    keys = [r.key for r in ingest.to_dlq(ingest.bad_rows(c)).orderBy("offset").collect()]
    assert keys == ["t:0", "t:1"]


def test_good_plus_bad_equals_input(spark):
    c = ingest.check_contract(records(spark, [GOOD, "{bad", with_(qty=KeyError), GOOD]))
    assert ingest.good_rows(c).count() + ingest.bad_rows(c).count() == 4


def test_filter_stays_above_parse(spark):
    c = ingest.check_contract(records(spark, [GOOD]))
    plan = ingest.bad_rows(c)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1


def test_normalize_feed_case_exact_keys(spark):
    msg = '{"e":"trade","E":99,"s":"BTCUSDT","t":12345,"p":"42000.10","q":"0.5","T":1700000000123,"m":true}'
    raw = spark.createDataFrame([(msg,)], "value string")
    (r,) = ingest.normalize_feed(raw, event_id=F.lit("x"), ingested_at=F.lit("now")).collect()
    assert (r.symbol, r.trade_id, r.trade_ts, r.price, r.qty, r.is_buyer_maker) == (
        "BTCUSDT", 12345, 1700000000123, 42000.10, 0.5, True)
    assert (r.schema_version, r.source) == (1, "binance_ws")
    (u,) = ingest.normalize_feed(raw).collect()
    assert len(u.event_id) == 36 and u.ingested_at.endswith("+00:00")


def test_partition_values(spark):
    from ticklake.functions.time import partition_values

    df = spark.createDataFrame([(M + 86_400_000 - 1,), (M + 86_400_000,)], "ms long")
    d, h = partition_values("ms")
    assert [tuple(r) for r in df.select(d, h).collect()] == [("2024-01-01", "23"), ("2024-01-02", "00")]


def test_encode_event_roundtrip(spark):
    c = ingest.check_contract(records(spark, [GOOD]))
    enc = ingest.encode_event(ingest.good_rows(c))
    rec = enc.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
                     F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.lit(0).cast("long").alias("offset"),
                     F.lit(None).cast("timestamp").alias("timestamp"))
    (r,) = ingest.check_contract(rec).collect()
    assert r.error is None and r.symbol == "BTCUSDT"


def test_ingest_counts(spark):
    c = ingest.check_contract(records(spark, [GOOD, "{bad", GOOD, GOOD]))
    got = {r.partition: (r.consumed, r.landed, r.dead_lettered, r.next_offset) for r in ingest.ingest_counts(c).collect()}
    assert got == {0: (2, 2, 0, 4), 1: (1, 0, 1, 2), 2: (1, 1, 0, 3)}


def test_minimal_mode_loses_nothing(spark):
    """A required key that is null or does not cast fails; other keys may be bad."""
    got = errors(spark, [with_(price="abc"), with_(trade_ts=None), with_(trade_ts="soon"), with_(is_buyer_maker="?"),
                         with_(source=KeyError), with_(price="1.5")], ingest.MINIMAL)
    assert got == ["type:price", "type:trade_ts", "type:trade_ts", None, None, None]


def test_trade_ts_range(spark):
    times = [0, M, M // 1000, 253402300799999, M * 1000, M * 1_000_000, -1, 2**63 - 1]
    for mode in (ingest.FULL, ingest.MINIMAL):
        got = errors(spark, [with_(trade_ts=t) for t in times], mode)
        assert got == [None] * 4 + ["range:trade_ts"] * 4
