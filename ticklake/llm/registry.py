"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from ticklake.llm import (
    decontaminate,
    flow_resharding,
    html_density,
    language_mixture,
    line_templates,
    merkle_manifest,
    prefix_free_phrases,
    simhash_bktree,
    soft_mixing,
    threshold_topk,
    toxicity,
    url_vocabulary,
    warc_index,
)

QUERIES = {
    "op1_soft_mixing": soft_mixing.op1_soft_mixing,
    "op2_line_templates": line_templates.op2_line_templates,
    "op3_language_mixture": language_mixture.op3_language_mixture,
    "op4_warc_index": warc_index.op4_warc_index,
    "op5_url_vocabulary": url_vocabulary.op5_url_vocabulary,
    "op6_html_density": html_density.op6_html_density,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_threshold_topk": threshold_topk.op8_threshold_topk,
    "op9_decontamination": decontaminate.op9_decontamination,
    "op10_simhash_neardup": simhash_bktree.op10_simhash_neardup,
    "op11_prefix_free_phrases": prefix_free_phrases.op11_prefix_free_phrases,
    "op12_flow_resharding": flow_resharding.op12_flow_resharding,
    "op13_merkle_manifest": merkle_manifest.op13_merkle_manifest,
}

# The other operators fit models, walk trees or parse whole documents: they
# are tested against brute force, round trips and held-out labels instead.
ORACLE = {
    "op4_warc_index": warc_index.ORACLE_SQL,
    "op5_url_vocabulary": url_vocabulary.ORACLE_SQL,
    "op8_threshold_topk": threshold_topk.ORACLE_SQL,
    "op11_prefix_free_phrases": prefix_free_phrases.ORACLE_SQL,
    "op13_merkle_manifest": merkle_manifest.ORACLE_SQL,
}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)
