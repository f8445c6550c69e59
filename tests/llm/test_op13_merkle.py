"""Merkle manifest: brute force over small tables, deep trees, odd rows."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from ticklake.llm import merkle_manifest as M
from ticklake.llm.registry import ORACLE, QUERIES

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, payload string, pos int, tree string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    fields = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return H(*("-" if v is None else f"{len(v.encode())}:{v}" for v in fields))


def climb(digests):
    """(root, [(left, right) per level] per leaf) of one tree."""
    paths, level, at = [[] for _ in digests], list(digests), list(range(len(digests)))
    while len(level) > 1:
        runs = [level[i : i + 8] for i in range(0, len(level), 8)]
        for i, p in enumerate(at):
            run, place = runs[p // 8], p % 8
            paths[i].append(("".join(run[:place]), "".join(run[place + 1 :])))
        level, at = [H(*r) for r in runs], [p // 8 for p in at]
    return level[0], paths


def brute(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    order = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    lower = {}
    for k in order:
        mine = sorted(trees[k], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        lower[k] = mine, *climb([leaf(*r) for r in mine])
    root, upper = climb([lower[k][1] for k in order]) if order else (None, [])
    out = []
    for k, up in zip(order, upper):
        mine, subroot, paths = lower[k]
        for r, path in zip(mine, paths):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            text = r[4] if r[4] is None or not hit else r[4].encode().lower().decode()
            h = leaf(*r[:4], text)
            for left, right in path + up:
                h = H(left, h, right)
            proof = H(*(a + b for a, b in path + up))
            out.append((r[0], leaf(*r), subroot, root, proof, h, h == root))
    return out


def spark_rows(spark, rows, tmp_path):
    spark.createDataFrame([(*r, "x", 7, "t") for r in rows], SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return [tuple(r) for r in QUERIES["op13_merkle_manifest"](spark, str(tmp_path)).collect()]


def key(t):
    return tuple((x is not None, x) for x in t)


@pytest.mark.parametrize("span", [3, 1])
def test_matches_brute_force(spark, tmp_path, monkeypatch, span):
    monkeypatch.setattr(M, "SPAN", span)  # one level a block: every tree takes several rounds
    monkeypatch.setattr(M, "_BLOCK", 8**span)
    rows = [(i, f"s{i % 3}", "en" if i % 10 else "é", i, f"Text {i}" * (i % 4)) for i in range(700)]
    rows += [(5000 + i, None, "de", None, "AbC") for i in range(9)] + [(6000, "s", "fr", 1, "lone")]
    rows += [(None, "s", None, None, None), (7, "s", None, 1, ""), (7, "s", None, 1, "Ä"), (8, "s", "", 1, "empty lang")]
    rows += [(9000, "s", "en", 3, "SAME")] * 20 + [(None, "s", "en", 1, "no id")] * 3 + [(9001, "s", "en", 1, "LONG " * 50_000)]
    rows += [(9002 + i, "s", f"l{i}", 1, "X") for i in range(20)]
    assert sorted(spark_rows(spark, rows, tmp_path), key=key) == sorted(brute(rows), key=key)


def test_empty_and_single(spark, tmp_path):
    assert spark_rows(spark, [], tmp_path / "a") == []
    one = [(3, "s", "en", 1, "A")]
    assert spark_rows(spark, one, tmp_path / "b") == brute(one)


def test_only_real_changes_are_found(spark, tmp_path):
    rows = [(i, "s", "en", 1, "UPPER" if i % 2 else "lower") for i in range(100)]
    for doc_id, *_, verified in spark_rows(spark, rows, tmp_path):
        assert verified == (not (doc_id % 2 and zlib.crc32(str(doc_id).encode()) % 3 == 0))


def test_sql_agrees(spark, sf_dir="/root/testdata/sf0.001"):
    from tests.oracle_check import compare

    name = "op13_merkle_manifest"
    assert compare(spark, name, sf_dir, ORACLE[name], QUERIES[name])["status"] == "match"


def test_no_python_and_no_driver_rows(spark):
    docs = spark.range(10).select(F.col("id").alias("k"), F.lit("a").alias("g"))
    found = M.manifest(docs, F.col("g"), F.col("k"), M.row_digest(F.col("k")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan and "CartesianProduct" not in plan
