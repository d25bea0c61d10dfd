"""The registered queries of this subpackage and, where SQL can express them, their DuckDB statements."""

from __future__ import annotations

from limes.llm import licenses, media, mil_quality, mixing, near_dup, packing, pii, prefix_trie, quality, ranked_search, substring_dedup, suffix_dedup, url_filters

QUERIES = {
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op2_media_columns": media.op2_media_columns,
    "op3_mixing": mixing.op3_mixing,
    "op4_packing": packing.op4_packing,
    "op5_suffix_dedup": suffix_dedup.op5_suffix_dedup,
    "op6_licenses": licenses.op6_licenses,
    "op7_pii": pii.op7_pii,
    "op8_url_filters": url_filters.op8_url_filters,
    "op9_quality": quality.op9_quality,
    "op10_near_duplicates": near_dup.op10_near_duplicates,
    "op11_ranked_search": ranked_search.op11_ranked_search,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_mil_quality": mil_quality.op13_mil_quality,
}

ORACLES = {
    "op6_licenses": licenses.ORACLE,
    "op8_url_filters": url_filters.ORACLE,
    "op11_ranked_search": ranked_search.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
}
