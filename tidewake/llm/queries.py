"""The numbered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from tidewake.llm import byte_bpe, conversation_repair, exact_dedup, importance, jaccard_join, language_id, line_dedup, media, packing, pii, quality_rules, token_shards, url_filter

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_language_id": language_id.op2_language_id,
    "op3_jaccard_join": jaccard_join.op3_jaccard_join,
    "op4_media_columns": media.op4_media_columns,
    "op5_line_dedup": line_dedup.op5_line_dedup,
    "op6_pii_surrogates": pii.op6_pii_surrogates,
    "op7_token_shards": token_shards.op7_token_shards,
    "op8_byte_bpe": byte_bpe.op8_byte_bpe,
    "op9_url_filters": url_filter.op9_url_filters,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_quality_rules": quality_rules.op11_quality_rules,
    "op12_importance_resampling": importance.op12_importance_resampling,
    "op13_conversation_repair": conversation_repair.op13_conversation_repair,
}
SQL = {
    "op5_line_dedup": line_dedup.SQL,
    "op9_url_filters": url_filter.SQL,
    "op10_exact_dedup": exact_dedup.SQL,
    "op12_importance_resampling": importance.SQL,
    "op13_conversation_repair": conversation_repair.SQL,
}
