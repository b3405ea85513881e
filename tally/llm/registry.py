"""Queries of this subpackage and their SQL, for the entry module."""

from __future__ import annotations

from tally.llm import (
    html_text,
    jaccard_join,
    language_id,
    mixture,
    packing,
    phrases,
    posting_search,
    quality_rules,
    sharding,
    spelling,
    substring_dedup,
    token_rollup,
    warc,
)

QUERIES = {
    "op1_best_fit_packing": packing.query,
    "op2_token_counts": token_rollup.query,
    "op3_nearest_neighbours": posting_search.query,
    "op4_language_id": language_id.query,
    "op5_warc": warc.query,
    "op6_source_mixing": mixture.query,
    "op7_sharding": sharding.query,
    "op8_html_extraction": html_text.query,
    "op9_jaccard_join": jaccard_join.query,
    "op10_quality_rules": quality_rules.query,
    "op11_spelling_variants": spelling.query,
    "op12_phrase_collocations": phrases.query,
    "op13_substring_dedup": substring_dedup.query,
}

SQL = {
    "op5_warc": warc.SQL,
    "op6_source_mixing": mixture.SQL,
    "op9_jaccard_join": jaccard_join.SQL,
    "op10_quality_rules": quality_rules.SQL,
    "op11_spelling_variants": spelling.SQL,
    "op12_phrase_collocations": phrases.SQL,
    "op13_substring_dedup": substring_dedup.SQL,
}
