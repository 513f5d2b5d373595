"""The queries of this subpackage, by name, and their DuckDB twins where SQL can express them."""

from __future__ import annotations

from tidemark.llm import decontamination, html_text, language_mixture, near_duplicates, pii, quality_rules, source_mixing, substring_dedup, token_counts, url_filters

QUERIES = {
    "op1_token_counts": token_counts.query,
    "op2_html_text": html_text.query,
    "op3_pii": pii.query,
    "op4_decontamination": decontamination.query,
    "op5_substring_dedup": substring_dedup.query,
    "op6_quality_rules": quality_rules.query,
    "op7_language_mixture": language_mixture.query,
    "op8_source_mixing": source_mixing.query,
    "op9_url_filters": url_filters.query,
    "op10_near_duplicates": near_duplicates.query,
}

ORACLES = {
    "op6_quality_rules": quality_rules.ORACLE_SQL,
    "op8_source_mixing": source_mixing.ORACLE_SQL,
}
