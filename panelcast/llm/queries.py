"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from panelcast.llm import (bpe_codec, conversation_repair, decontaminate, html_lstm, language_id, minhash_forest, oracles, quality_rules, rule_classifier, suffix_dedup,
                           token_counts, token_files, topk_search, vector_codes)

QUERIES = {f.__name__: f for f in (
    token_files.op1_token_files, quality_rules.op2_quality_rules, bpe_codec.op3_bpe_codec, decontaminate.op4_decontaminate,
    rule_classifier.op5_rule_classifier, suffix_dedup.op6_suffix_dedup, token_counts.op7_token_counts, html_lstm.op8_html_lstm,
    language_id.op9_language_id, minhash_forest.op10_minhash_forest,
    conversation_repair.op11_conversation_repair, vector_codes.op12_vector_codes, topk_search.op13_topk_search)}
ORACLE_SQL: dict[str, str] = {"op6_suffix_dedup": oracles.SUFFIX_DEDUP, "op10_minhash_forest": oracles.MINHASH_FOREST,
                               "op11_conversation_repair": oracles.CONVERSATION_REPAIR, "op12_vector_codes": oracles.VECTOR_CODES, "op13_topk_search": oracles.TOPK_SEARCH}
