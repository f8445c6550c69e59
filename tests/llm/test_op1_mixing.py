"""Soft mixing against numpy, and plan shape."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import functions as F

from ticklake.llm import soft_mixing as M

SF = "/root/testdata/sf0.01"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_totals_reach_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    table = M.fit_domains(docs, M.quality_domains(docs, labels))
    df, mix = M.mix(docs, table, M.WEIGHTS)
    rows = df.collect()
    assert len(rows) == docs.count()
    # replay in numpy
    n = np.array([r.n_tokens for r in rows], float)
    p = np.array([[r.posterior[d] for d in mix.table.domains] for r in rows])
    assert np.allclose(p.sum(1), 1)
    rate = np.ones(len(rows))
    for g in mix.steps:
        rate = np.maximum(0, rate - p @ np.array(g))
    assert np.allclose(rate, [r.rate for r in rows])
    assert np.allclose((rate * n) @ p, mix.after, rtol=1e-6)
    gap = max(abs(a - t) for a, t in zip(mix.after, mix.targets)) / n.sum()
    assert gap <= M.TOLERANCE and np.allclose([r.target_gap for r in rows], gap, rtol=1e-9)
    assert not re.search("Python|Pandas|Arrow", plan_of(df) + plan_of(table.with_posterior(M.with_features(docs))))


def test_posteriors_equal_naive_bayes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    labelled = docs.where("lang is not null").select("doc_id", F.col("lang").alias("domain"))
    table = M.fit_domains(docs, labelled)
    rows = table.with_posterior(M.with_features(docs)).collect()
    for r in rows[:50]:
        score = np.array(table.prior)
        for k, (v, cuts) in enumerate(zip(r["_mix_x"], table.cuts)):
            score += [cell[k][sum(c < v for c in cuts)] for cell in table.cells]
        want = np.exp(score - score.max())
        assert np.allclose(r["_mix_p"], want / want.sum())
        text = r.text or ""
        assert r["_mix_n"] == len(re.findall(r"[^ \t\n\x0b\f\r]+", text))
        assert abs(r["_mix_x"][0] - len(re.findall("[A-Z]", text)) / max(1, len(text))) < 1e-12
    right = sum(r.lang == table.domains[int(np.argmax(r["_mix_p"]))] for r in rows) / len(rows)
    assert right > 0.9


def mass_of(spark, n, p):
    return spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p)], "n long, p array<double>")


def flat(domains):
    return M.DomainTable([f"d{k:03}" for k in range(domains)], [], [], [])


def plain_rates(n, p, targets, rounds=20_000):
    """Nonnegative rates by plain multiplicative updates (no projection, no metric)."""
    rate = np.ones(len(n))
    b = p * n[:, None]
    for _ in range(rounds):
        rate *= (b @ targets) / np.maximum(b @ (rate @ b), 1e-300)
    return rate


def test_rare_domain_reaches_its_target(spark):
    """One ten-thousandth of the tokens, clean and blurred posteriors."""
    rng = np.random.default_rng(5)
    d = rng.integers(1, 6, 20_000)
    d[:2] = 0
    n = np.full(len(d), 100)
    for blur in (0.0, 1e-3):
        p = (1 - 6 * blur) * np.eye(6)[d] + blur
        weights = {"d000": 0.16} | {f"d{k:03}": 0.168 for k in range(1, 6)}
        mix = M.solve(mass_of(spark, n, p), flat(6), weights)
        assert max(map(abs, mix.gaps.values())) <= M.TOLERANCE, blur
        rate = np.ones(len(n))
        for g in mix.steps:
            rate = np.maximum(0, rate - p @ np.array(g))
        assert np.allclose((rate * n) @ p, mix.after)


def test_solution_equals_least_squares(spark):
    """In reach: as good as an independent solution. Out of reach: the gap is told."""
    rng = np.random.default_rng(6)
    n = rng.integers(1, 500, 300)
    p = rng.dirichlet([0.3] * 4, 300)
    for w in ([0.7, 0.1, 0.1, 0.1], [0.05, 0.05, 0.45, 0.45]):
        mix = M.solve(mass_of(spark, n, p), flat(4), {f"d{k:03}": v for k, v in enumerate(w)})
        target = np.array(w) * n.sum()
        best = plain_rates(n, p, target)
        assert np.abs((best * n) @ p - target).max() < 0.002 * n.sum()
        assert max(map(abs, mix.gaps.values())) <= M.TOLERANCE
    # every document is half d000, so nine tenths of it are out of reach: 0.5 r B, r B
    p = np.full((50, 2), 0.5)
    mix = M.solve(mass_of(spark, n[:50], p), flat(2), {"d000": 0.9, "d001": 0.1})
    assert abs(mix.gaps["d000"] + mix.gaps["d001"]) < 0.81 and max(map(abs, mix.gaps.values())) > 0.1


def test_many_domains(spark):
    rng = np.random.default_rng(7)
    d = np.concatenate([np.arange(130), rng.integers(0, 130, 1000)])
    n = rng.integers(50, 150, len(d))
    p = 0.98 * np.eye(130)[d] + 0.02 / 130
    mix = M.solve(mass_of(spark, n, p), flat(130), {f"d{k:03}": 1 + k % 3 for k in range(130)})
    assert max(map(abs, mix.gaps.values())) <= M.TOLERANCE and len(mix.gaps) == 130


def test_seventy_labelled_domains(spark):
    rows = [(i, f"text {i} of some words", f"l{i % 70:02}") for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(700)] + [(0, 0)] * 30, "doc_id long, quality int")
    got = M.mix_documents(docs, labels, {f"l{k:02}/1": 1.0 for k in range(70)}).collect()
    assert len(got) == 700 and len(got[0].posterior) == 70


def test_hot_labelled_id(spark):
    """An id that a third of all rows share counts as one row of the sample."""
    rows = [(1, f"hot row {i}", "en") for i in range(200)] + [(i, f"ein Text {i}!", "de") for i in range(2, 22)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labelled = docs.select("doc_id", F.col("lang").alias("domain"))
    table = M.fit_domains(docs, labelled)
    assert np.allclose(np.exp(table.prior), [20 / 21, 1 / 21])


def test_edges(spark):
    rows = [(1, None, "en", "x"), (2, "", "en", "x"), (None, "Hello there", None, "x"), (3, " one  two ", "de", "x"), (3, " one  two ", "de", "x"),
            (4, "word " * 100_000, "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, rate string")
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (4, 1, 0), (4, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = M.mix_documents(docs, labels).collect()
    assert len(got) == 6 and all(r.rate >= 0 for r in got)
    tokens = {r.doc_id: r.n_tokens for r in got}
    assert tokens == {1: 0, 2: 0, None: 2, 3: 2, 4: 100_000}
    assert M.mix_documents(docs, labels.limit(0)).select("rate").distinct().first()[0] == 1.0
    assert M.mix_documents(docs.limit(0), labels).count() == 0
