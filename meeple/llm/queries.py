"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from meeple.llm import (
    bloom_search,
    exact_dedup,
    html_extract,
    maxent_lm,
    mixing,
    near_dedup,
    pii,
    piece_fst,
    quality_rules,
    sharding,
    token_counts,
    toxicity,
    whitening,
)

QUERIES = {
    "op1_sharding": sharding.op1_sharding,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_token_counts": token_counts.op3_token_counts,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_quality_rules": quality_rules.op5_quality_rules,
    "op6_html_extraction": html_extract.op6_html_extraction,
    "op7_near_dedup": near_dedup.op7_near_dedup,
    "op8_mixing": mixing.op8_mixing,
    "op9_maxent_lm": maxent_lm.op9_maxent_lm,
    "op10_sentencepiece": piece_fst.op10_sentencepiece,
    "op11_search": bloom_search.op11_search,
    "op12_pii": pii.op12_pii,
    "op13_whitening": whitening.op13_whitening,
}

ORACLE = {
    "op4_exact_dedup": exact_dedup.OP4_SQL,
    "op11_search": bloom_search.OP11_SQL,
}
