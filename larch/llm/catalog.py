"""Registered queries of the llm operators and their SQL."""

from __future__ import annotations

from larch.llm import alignment, arrow_tokens, exact_dedup, html_extract, language_id, language_scoring, mixing, near_dedup, packing, preferences, quality_rules, spelling, substring_dedup

QUERIES = {
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op4_near_dedup": near_dedup.op4_near_dedup,
    "op5_source_mixing": mixing.op5_source_mixing,
    "op6_arrow_tokens": arrow_tokens.op6_arrow_tokens,
    "op8_pattern_packing": packing.op8_pattern_packing,
    "op3_quality_rules": quality_rules.op3_quality_rules,
    "op1_html_extraction": html_extract.op1_html_extraction,
    "op7_preference_formatting": preferences.op7_preference_formatting,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_language_id": language_id.op10_language_id,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_token_alignment": alignment.op12_token_alignment,
    "op13_lm_scoring": language_scoring.op13_lm_scoring,
}

ORACLE = {
    "op7_preference_formatting": preferences.SQL,
    "op9_exact_dedup": exact_dedup.SQL,
}
