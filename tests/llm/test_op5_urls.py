"""URL rules and vocabulary."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticklake.llm import url_vocabulary as U


def judge(spark, urls):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash"))
    return [tuple(r)[1:5] for r in U.judge_urls(df).orderBy("page_id").collect()]


def test_rules_hosts_and_paths(spark):
    urls = [
        "http://Example.COM/en/1?q=1", "https://www.example.com/en/x#t", "http://a.net/es/", "http://net/fr/2", "http://anet/fr/2",
        "http://b.com", "http://b.com/", "http://x.org/?a://c.com/", "no scheme", "", None, "a://b://c/d", "http://example.com/EN/1",
    ]
    assert judge(spark, urls) == [
        ("example.com", "/en/1", "example.com/en/", "block"), ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        ("a.net", "/es/", "net/es/", "block"), ("net", "/fr/2", "net/fr/", "block"), ("anet", "/fr/2", None, "allow"),
        ("b.com", "", None, "allow"), ("b.com", "/", "com/", "allow"), ("x.org", "/", None, "allow"), ("", "", None, "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("b:", "//c/d", None, "allow"), ("example.com", "/EN/1", "com/", "allow"),
    ]


def test_vocabulary(spark):
    urls = [
        "http://casino.org/", "http://casinos1.org/", "http://cheap.org/pills", "http://cheap.org/cheap", "http://CHEAP-PILLS.org/",
        "http://cheaper.org/pills", "http://casino.com/", "http://x.org/" + "a/" * 50_000 + "spam", "http://éspam.org/",
    ]
    assert [v for *_, v in judge(spark, urls)] == ["block", "allow", "block", "allow", "block", "allow", "allow", "block", "block"]


def test_empty(spark):
    assert U.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_equals_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    got = sorted(map(str, (tuple(r) for r in U.op5_url_vocabulary(spark, sf).collect())))
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{sf}/pages.parquet'")
    assert got == sorted(map(str, con.sql(U.ORACLE_SQL).fetchall()))
