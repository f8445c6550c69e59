"""Template tree against a plain, single-process version."""

from __future__ import annotations

import re

import corpus_pipeline as P
import numpy as np
import pytest
from pyspark.sql import functions as F

from ticklake.llm import line_templates as L

SF = "/root/testdata/sf0.001"


def plain_mask(line):
    return " ".join("<*>" if re.search("[0-9]", w) else w for w in re.split(r"[ \t\n\x0b\f\r]+", line) if w)


def plain_drop(docs):
    """doc_id -> kept text, by filing distinct lines in text order."""
    leaves, of = {}, {}
    for m in sorted({plain_mask(l) for _, t in docs if t is not None for l in t.split("\n")}, key=lambda s: s.encode()):
        w = m.split(" ")
        if len(w) < L.MIN_TOKENS:
            continue
        leaf = leaves.setdefault((len(w), *w[: L.LEADING]), [])
        for t in leaf:
            if sum(a == b for a, b in zip(t[0], w)) >= L.SIMILARITY * len(w):
                t[0] = [a if a == b else "<*>" for a, b in zip(t[0], w)]
                break
        else:
            leaf.append(t := [w, set()])
        of[m] = t
    for d, t in docs:
        for l in (t or "").split("\n"):
            if plain_mask(l) in of:
                of[plain_mask(l)][1].add(d)
    out = {}
    for d, t in docs:
        if t is not None:
            out[d] = "\n".join(l for l in t.split("\n") if plain_mask(l) not in of or min(of[plain_mask(l)][1]) == d)
        else:
            out[d] = None
    return out


def test_equals_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    want = plain_drop([tuple(r) for r in docs.collect()])
    got = {r.doc_id: r.text for r in L.drop_recurring(docs).collect()}
    assert got == want
    assert any(len(want[d] or "") < len(t or "") for d, t in docs.collect())


@pytest.mark.parametrize("chunk", [2000, 3])
def test_templates_and_edges(spark, chunk):
    words = "the quick brown fox jumps over a lazy dog today"
    rows = [
        (3, f"user 17 logged in from home\n{words}\nonly here in three", "x"),
        (1, f"user 4 logged in from home\n{words.replace('lazy', 'tired')}\nab", "x"),
        (2, f"{words.replace('dog', 'cat')}\r\nab\nab", "x"),
        (None, words, "x"), (4, None, "x"), (5, "", "x"), (6, "twice in one document\ntwice in one document", "x"),
        (6, "another row of six", "x"), (7, "\n".join(f"line number {i} of a very long text" for i in range(20_000)), "x"),
        (8, words + "\n" + "the quick brown fox sat down on some other rug", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lines_dropped string")
    got = {}
    for r in L.drop_recurring(docs, chunk=chunk).collect():
        got.setdefault(r.doc_id, []).append(r.text)
    assert got[1] == [rows[1][1]]  # the smallest doc_id keeps its lines
    assert got[3] == ["only here in three"]
    assert got[2] == ["ab\nab"] and got[None] == [""] and got[4] == [None] and got[5] == [""]
    assert sorted(got[6]) == sorted([rows[6][1], rows[7][1]]) and got[7] == [rows[8][1]]
    assert got[8] == ["the quick brown fox sat down on some other rug"]
    assert L.drop_recurring(docs.limit(0)).count() == 0


def test_hot_line_and_hot_leaf(spark):
    df = spark.range(400).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("one very common line here\nthe same first words x"), F.col("id").cast("string"), F.lit(" and q"), F.chr(97 + F.col("id") % 26), F.lit(" r")).alias("text"),
    )
    got = {r.doc_id: r.text for r in L.drop_recurring(df, chunk=5).collect()}
    assert got[0].startswith("one very common") and all("common" not in got[i] for i in range(1, 400))


def test_lines_of_mostly_fields_match_exactly(spark):
    rows = [
        (1, "2019 12.4 13.1 8.8\n1 2 3 4 total\nthe year 1 to 2"), (2, "1998 3 4 5\n2019  12.4 13.1 8.8\n1 2 3 5 total"),
        (3, "the year 3 to 4\nred 1 2 fish\nred <b> ran home"), (4, "blue 1 2 fish"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in L.drop_recurring(docs).collect()}
    assert got == {1: rows[0][1], 2: "1998 3 4 5\n1 2 3 5 total", 3: "red 1 2 fish\nred <b> ran home", 4: "blue 1 2 fish"}


def test_shared_fields_are_no_likeness():
    tree = L.LeafTemplates(0.8)
    assert tree.file(np.array([0, 1, 2, -1, -1]), 7) == 0
    assert tree.file(np.array([0, 1, 3, -1, -1]), 8) == 1  # 2 of 3 constants
    assert tree.file(np.array([0, 1, 2, -1, -1]), 9) == 0


def test_short_recurring_lines_go(spark, tmp_path):
    rows = [(1, "All rights reserved.\n\nShare\none two"), (2, "All  rights reserved.\nShare\n\none three\nPage 7"), (3, "Page 9\nx\n\ny")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.lines_dropped, r.chars_kept) for r in L.op2_line_templates(spark, str(tmp_path)).collect()}
    assert got == {1: (0, len(rows[0][1])), 2: (2, len("\none three\nPage 7")), 3: (1, len("x\n\ny"))}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.text for r in P.line_dedup(spark, docs, None).collect()} == {1: rows[0][1], 2: "\none three\nPage 7", 3: "x\n\ny"}


def plain_links(rows, similarity):
    """Components of the templates that are alike, by comparing all pairs."""
    root = {t: t for t, _ in rows}
    for a, x in rows:
        for b, y in rows:
            both = sum(p == q == "<*>" for p, q in zip(x, y))
            if len(x) == len(y) and sum(p == q for p, q in zip(x, y)) - both >= similarity * (len(x) - both):
                low, high = sorted((root[a], root[b]))
                root = {t: low if r == high else r for t, r in root.items()}
    return {t: r for t, r in root.items() if sum(q == r for q in root.values()) > 1}


@pytest.mark.parametrize("size,words", [(5, 4), (10, 3), (12, 5), (21, 2)])
def test_links_of_a_hot_leaf_equal_all_pairs(spark, size, words):
    """Groups of at most 4, so that every way of dealing a leaf anew is met."""
    rng = np.random.default_rng(size)
    pool = ["<*>", *"abcdefg"[: words]]
    rows = [(k, ["x", "<*>", "z", *rng.choice(pool, size - 3, p=[0.1] + [0.9 / words] * words)]) for k in range(150)]
    rows += [(1000 + k, [w if rng.random() > 0.1 else "q" for w in rows[k][1][:3] + rows[k][1][3:]]) for k in range(0, 60)]
    rows = [(k, ["x", "<*>", "z", *map(str, r[3:])]) for k, r in rows]
    heads = spark.createDataFrame([(7, k, " ".join(r)) for k, r in rows], "leaf long, template long, pattern string")
    got = {r.node: r.component for r in L.components(L.alike(heads, 0.8, 4)).collect()}
    assert got == plain_links(rows, 0.8)


def test_rows_without_id_lose_their_own_lines(spark):
    """Null ids are one document, yet each row is cut by its own lines alone."""
    rows = [(None, f"a line that two rows share {'abc'[i % 3]}\nown words of row {'abcdefghij'[i]} stay here today") for i in range(10)]
    docs = spark.createDataFrame([(1, "a line that two rows share a"), *rows], "doc_id long, text string")
    got = [r.text for r in L.drop_recurring(docs).where("doc_id is null").collect()]
    assert all("share" not in t for t in got) and len(got) == 10
