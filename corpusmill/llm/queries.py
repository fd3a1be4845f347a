"""The registered queries of the training-data operators, and SQL for those that DuckDB can express on whole tables."""

from __future__ import annotations

from . import embedding_dedup, jaccard, line_dedup, merkle_manifest, mixing, oracles, packing, quality, spelling, substring_dedup, suffix_dedup, token_counts, token_files, toxicity

QUERIES = {
    "op1_embedding_dedup": embedding_dedup.op1_embedding_dedup,
    "op2_source_mix": mixing.op2_source_mix,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_quality_rules": quality.op4_quality_rules,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_suffix_dedup": suffix_dedup.op7_suffix_dedup,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_token_files": token_files.op9_token_files,
    "op10_ngram_jaccard": jaccard.op10_ngram_jaccard,
    "op11_substring_dedup": substring_dedup.op11_substring_dedup,
    "op12_merkle_manifest": merkle_manifest.op12_merkle_manifest,
    "op13_spelling_variants": spelling.op13_spelling_variants,
}

SQL = {
    "op1_embedding_dedup": oracles.OP1_SQL,
    "op8_line_dedup": line_dedup.OP8_SQL,
    "op10_ngram_jaccard": oracles.OP10_SQL,
    "op11_substring_dedup": substring_dedup.OP11_SQL,
    "op12_merkle_manifest": merkle_manifest.OP12_SQL,
    "op13_spelling_variants": spelling.OP13_SQL,
}
