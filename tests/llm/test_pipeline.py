"""The corpus pipeline, stage by stage, on the small table."""

from __future__ import annotations

import corpus_pipeline as P
from pyspark.sql import functions as F
from test_op9_decontamination import plain_hits

from ticklake.llm import simhash_bktree
from ticklake.llm.common import stored, table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    names, bench = docs.columns, [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "simhash_neardup", "decontamination", "mixing"]
    seen = {}
    for name, stage in P.STAGES:
        before = docs
        docs = stored(stage(spark, docs, SF), name)
        seen[name] = (before, docs)
        if name != "mixing":
            assert docs.columns == names
    before, after = seen["line_dedup"]
    assert before.count() == after.count()
    before, after = seen["simhash_neardup"]
    groups = {r.component_id for r in simhash_bktree.simhash_components(before).collect()}
    assert {r.doc_id for r in after.collect()} == groups
    before, after = seen["decontamination"]
    hits = plain_hits([(r.doc_id, r.text) for r in before.collect()], bench)
    assert {r.doc_id for r in after.collect()} == {h[0] for h in hits if not h[5]}
    before, after = seen["mixing"]
    assert before.count() == after.count() and {"rate", "posterior"} <= set(after.columns)
    assert P.run(spark, SF).count() == after.count()


def test_internal_names_may_clash(spark):
    """A table with the names that the stages use inside goes through unchanged."""
    docs = table(spark, SF, "documents").limit(120)
    clash = ("_doc", "doc", "_cut", "_kept", "row", "fp", "several", "score", "_tox_p1", "_tox_x", "_tox_score", "_mix_w", "_mix_n", "_mix_p",
             "component_id", "doc_key", "line", "lines_dropped_", "hit", "key", "a.b")
    wide = docs.select("*", *(F.col("doc_id").cast("string").alias(c) for c in clash))
    for name, stage in P.STAGES:
        plain, docs = docs, stored(stage(spark, docs, SF), name)
        wide = stored(stage(spark, wide, SF), name + "-wide")
        assert wide.count() == docs.count(), name
        for c in clash:
            assert wide.where(~F.col(f"`{c}`").eqNullSafe(F.col("doc_id").cast("string"))).isEmpty(), (name, c)


def test_unrelated_texts_of_one_id_stay(spark):
    rows = [(1, "first text of some words here"), (1, "quite another story told with other words"), (1, "First text of some words here"),
            (2, "first text of some words here"), (3, "a third one that nobody copied at all")]
    kept = simhash_bktree.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text.lower()) for r in kept) == sorted({(i, t.lower()) for i, t in rows if i != 2})
