"""Corpus pipeline: staged cleaning of ``documents`` with the operators of ticklake.llm.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; ``run`` writes each stage and reads it again, so a lost executor goes
back no further than the last stage.
"""

from __future__ import annotations

from ticklake.llm import decontaminate, line_templates, simhash_bktree, soft_mixing
from ticklake.llm import toxicity as toxic_trees
from ticklake.llm.common import stored, table


def toxicity(spark, docs, sf_dir):
    """Documents that the calibrated trees call toxic go (operator 7)."""
    return toxic_trees.drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark, docs, sf_dir):
    """Lines whose template recurs stay in their first document only (operator 2)."""
    return line_templates.drop_recurring(docs, min_tokens=1).drop("lines_dropped", "chars_dropped")


def simhash_neardup(spark, docs, sf_dir):
    """One document of each SimHash group stays (operator 10)."""
    return simhash_bktree.keep_one(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that hold a window of a benchmark item go (operator 9)."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark, docs, sf_dir):
    """Every document with its domain posterior and rate (operator 1)."""
    return soft_mixing.mix_documents(docs, table(spark, sf_dir, "labels"))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash_neardup", simhash_neardup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# The stages fit models, cluster lines and walk trees; SQL cannot express them.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
