"""Queries opN_<name> for the driver, and their SQL where SQL can express them."""

from __future__ import annotations

from medallion.llm import conversation_repair, exact_dedup, lm_scoring, near_dedup, packing, periodic_runs, pieces, pii, quality, quality_classifier, sharding, substring_dedup, url_filters

QUERIES = {
    "op1_pii": pii.op1_query,
    "op2_lm_scoring": lm_scoring.op2_query,
    "op3_exact_dedup": exact_dedup.op3_query,
    "op4_pieces": pieces.op4_query,
    "op5_sharding": sharding.op5_query,
    "op6_url_filters": url_filters.op6_query,
    "op7_minhash_near_dedup": near_dedup.op7_query,
    "op8_suffix_dedup": substring_dedup.op8_query,
    "op9_best_fit_packing": packing.op9_query,
    "op10_quality_rules": quality.op10_query,
    "op11_conversation_repair": conversation_repair.op11_query,
    "op12_quality_classifier": quality_classifier.op12_query,
    "op13_periodic_runs": periodic_runs.op13_query,
}

SQL = {
    "op3_exact_dedup": exact_dedup.OP3_SQL,
    "op6_url_filters": url_filters.OP6_SQL,
}
