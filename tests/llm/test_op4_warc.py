"""WARC round trip and index merge."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random

import duckdb
from pyspark.sql import functions as F

from ticklake.llm import warc_index as W

SF = "/root/testdata/sf0.001"


def plain(rows, least=0):
    top = {}
    for p, _, html in rows:
        k = html or ""
        top[k] = max(top.get(k, -(1 << 70)), -(1 << 69) if p is None else p)
    out = []
    for p, _, html in rows:
        data = (html or "").encode()
        best = top[html or ""]
        revisit = len(data) >= least and best > -(1 << 69) and p != best
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((p, len(data), digest, "revisit" if revisit else "response", best if revisit else None))
    return sorted(out, key=str)


def test_query_round_trip(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()
    got = W.op4_warc_index(spark, SF).collect()
    assert all(r.digest_ok for r in got)
    assert sorted((tuple(r)[:5] for r in got), key=str) == plain(rows)
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{SF}/pages.parquet'")
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, con.sql(W.ORACLE_SQL).fetchall()))


def test_edges(spark):
    nasty = "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nxyz\u0000é\U0001F600"
    rows = [(1, "http://a.b/x", "same"), (5, "http://a.b/x", "same"), (3, None, "same"), (None, "u", "same"), (None, "v", "alone"),
            (7, "http://q/\r\nHost: x", nasty), (8, "http://q/", None), (9, "http://q/", ""), (5, "http://a.b/x", "same"),
            (10, "http://long/", "x" * 300_000), (-4, "http://neg/", "n"), (-1, "http://neg/1", "m"), (-1, None, "mins"), (-2, "u", "mins")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    got = W.capture_histories(df)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()), key=str) == plain(rows)
    assert got.where("not digest_ok").count() == 0
    con = duckdb.connect()
    con.sql("create table pages (page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", rows)
    cols = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "digest_ok")
    assert sorted(str(tuple(r)) for r in got.select(*cols).collect()) == sorted(map(str, con.sql(W.ORACLE_SQL).fetchall()))
    few = W.capture_histories(df, min_bytes=5)
    assert few.where("record_type = 'revisit'").count() == 0
    assert W.capture_histories(df.limit(0)).count() == 0


def test_merged_order(spark):
    rows = [(i, f"http://{'abc'[i % 3]}.x/{i % 4}", f"p{i % 9}") for i in range(500)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    got = W.capture_histories(df).orderBy("part", "position").select(*W.KEY).collect()
    assert len(got) == 500 and got == sorted(got)


def test_loser_tree():
    rng = random.Random(3)
    for k in (0, 1, 2, 3, 5, 8, 13):
        lists = [sorted((rng.randrange(50), i, j) for j in range(rng.randrange(9))) for i in range(k)]
        assert list(W.LoserTree(lists)) == sorted(x for y in lists for x in y)


def test_archives_are_whole_records(spark, tmp_path):
    df = spark.createDataFrame([(i, f"http://a/{i}", f"h{i}") for i in range(25)], "page_id long, url string, html string")
    W.write_archives(df.coalesce(1), str(tmp_path / "w"), records_per_file=10)
    files = sorted((tmp_path / "w").glob("part-*"))
    counts = [len(list(W.parse_archive(gzip.decompress(f.read_bytes())))) for f in files]
    assert sum(counts) == 25 and max(counts) <= 10
