"""Queries of the training-data operators, and SQL for those that have it."""

from __future__ import annotations

from confluo.llm import byte_bpe, decontamination, line_dedup, lsh_forest, oracle, quality_model, quality_rules, sharding, substring_dedup, token_count, wavelet

QUERIES = {
    f.__name__: f
    for f in (
        token_count.op1_token_counts,
        byte_bpe.op2_byte_bpe,
        substring_dedup.op3_substring_dedup,
        sharding.op4_sharding,
        wavelet.op5_wavelet,
        decontamination.op6_decontamination,
        lsh_forest.op7_lsh_forest,
        line_dedup.op8_line_dedup,
        quality_rules.op9_quality_rules,
        quality_model.op10_quality_model,
    )
}
ORACLE_SQL = sharding.ORACLE_SQL | oracle.ORACLE_SQL
