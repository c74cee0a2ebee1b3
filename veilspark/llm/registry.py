"""Queries and oracle SQL of the training-data operators, for the entry module."""

from __future__ import annotations

from veilspark.llm import bpe, exact_dedup, jaccard_join, language_id, mixing, packing, periodic_runs, quality, sharding, suffix_dedup, token_files, toxicity, whitening

QUERIES = {
    "op1_mixing": mixing.query,
    "op2_sharding": sharding.query,
    "op3_suffix_dedup": suffix_dedup.query,
    "op4_language_id": language_id.query,
    "op5_bpe": bpe.query,
    "op6_toxicity": toxicity.query,
    "op7_quality": quality.query,
    "op8_token_files": token_files.query,
    "op9_jaccard_join": jaccard_join.query,
    "op10_exact_dedup": exact_dedup.query,
    "op11_whitening": whitening.query,
    "op12_packing": packing.query,
    "op13_periodic_runs": periodic_runs.query,
}

ORACLE_SQL = {"op1_mixing": mixing.ORACLE, "op10_exact_dedup": exact_dedup.ORACLE}
