"""The queries of this package by name, and the DuckDB SQL of those that SQL can state."""

from __future__ import annotations

from ledgerline.llm import chat_format, decontaminate, language, lm_score, near_dup, neighbours, packing, pii, quality, sharding, spelling, toxicity, whitening

QUERIES = {
    "op1_qda_quality": quality.op1_qda_quality,
    "op2_collision_neighbours": neighbours.op2_collision_neighbours,
    "op3_maglev_sharding": sharding.op3_maglev_sharding,
    "op4_simhash_decontamination": decontaminate.op4_simhash_decontamination,
    "op5_minhash_dedup": near_dup.op5_minhash_dedup,
    "op6_crf_language": language.op6_crf_language,
    "op7_anchor_pii": pii.op7_anchor_pii,
    "op8_lexicon_toxicity": toxicity.op8_lexicon_toxicity,
    "op9_cutting_stock_packing": packing.op9_cutting_stock_packing,
    "op10_ppm_scoring": lm_score.op10_ppm_scoring,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_chat_format": chat_format.op12_chat_format,
    "op13_exact_whitening": whitening.op13_exact_whitening,
}

ORACLE_SQL: dict[str, str] = {"op3_maglev_sharding": sharding.ORACLE, "op12_chat_format": chat_format.ORACLE}
