"""Collocations: brute force, any chunking, odd texts."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from ticklake.llm import prefix_free_phrases as P
from ticklake.llm.registry import ORACLE, QUERIES

SCHEMA = "doc_id long, text string, lang string, gram string, f int, freq int"


def brute(rows, order=3, least=10, cover=50, top=2000):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, order + 1):
                for i in range(len(words) - m + 1):
                    g = lang, tuple(words[i : i + m])
                    f[g] = f.get(g, 0) + 1
    out = {}
    cands = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= least}
    around = {}
    for (lang, p), a in cands.items():
        for i in range(len(p)):
            for j in range(i + 2, len(p) + 1):
                if j - i < len(p):
                    around[lang, p[i:j]] = max(a, around.get((lang, p[i:j]), 0))
    for (lang, p), a in cands.items():
        if 100 * around.get((lang, p), -1) >= cover * a:
            continue
        cut = min((1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        k = cut[1]
        out.setdefault(lang, []).append((-cut[0], -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
        for lang, found in out.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])
    )


def texts(n=600):
    rnd = random.Random(3)
    words = ["the", "a", "of", "New", "york", "São", "é", "x y", "İ", "nbsp", "co-op", "7", "日本"]
    marks = [" ", " ", " ", " ", ". ", ",", "\t", "\n", "  ", "\r\n", "?! ", "\x0b"]
    make = lambda: "".join(w for _ in range(rnd.randrange(0, 60)) for w in (rnd.choice(words), rnd.choice(marks)))
    rows = [(make(), rnd.choice(["en", "en", "fr", None, "und", ""])) for _ in range(n)]
    rows += [("New York City is big. " * 40, "en")] * 30 + [(None, "en"), ("", "fr"), (" . ,", "de"), ("one", "es")]
    return rows + [("same " * 3000, "en"), ("no stop " * 400 + "the end", "fr"), ("a\n" * 500, None)]


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, g, "x", 1, 2) for i, (t, g) in enumerate(rows)], SCHEMA).repartition(5)
    return sorted(tuple(r) for r in P.collocations(df, **kw).collect())


def test_matches_brute_force(spark):
    assert run(spark, texts()) == brute(texts())


@pytest.mark.parametrize("modulus, longest", [(1, 256), (3, 2), (10**9, 7)])
def test_counts_do_not_depend_on_the_chunks(spark, monkeypatch, modulus, longest):
    monkeypatch.setattr(P, "MODULUS", modulus)
    monkeypatch.setattr(P, "LONGEST", longest)
    monkeypatch.setattr(P, "HELD", 10)
    monkeypatch.setattr(P, "MOST_BITS", 64)  # a filter that lets nearly all pass
    monkeypatch.setattr(P, "BUCKET_ROWS", 3)
    assert run(spark, texts(150), order=4, min_count=3, top=5) == brute(texts(150), order=4, least=3, top=5)


def test_overlaps_belong_to_one_chunk():
    rnd = random.Random(5)
    for _ in range(200):
        toks = [rnd.choice([b"a", b"b", b"c", b"dd"]) for _ in range(rnd.randrange(0, 80))]
        found = list(P.parse(toks, 3))
        assert sum(own for _, own in found) == len(toks)
        at = 0
        for chunk, own in found:
            assert chunk.split(b" ") == toks[at : at + own + 2]
            at += own


def test_empty(spark):
    assert run(spark, [(None, "en"), ("", None)]) == []
    assert P.collocations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_large_counts_stay_exact(spark):
    big = 4 * 10**12
    row = spark.createDataFrame([(big, big + 1, big + 3)], "a long, l long, r long")
    want = 1_000_000 * big * big // ((big + 1) * (big + 3))
    assert row.select(P.score(row.a, row.l, row.r)).first()[0] == want


def test_sql_agrees(spark):
    from tests.oracle_check import compare

    name = "op11_prefix_free_phrases"
    res = compare(spark, name, "/root/testdata/sf0.01", ORACLE[name], QUERIES[name])
    assert res["status"] == "match" and res["spark_rows"] > 1000
