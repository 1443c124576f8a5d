"""Registered queries of the operators, and oracle SQL where SQL can express them."""

from __future__ import annotations

from lapworks.llm import (alignment, exact_dedup, fingerprints, jaccard, merkle, mixing, neighbours, packing, pii,
                          rollup, sharding, substring, toxicity)

QUERIES = {
    "op1_substring_dedup": substring.query,
    "op2_mix_sources": mixing.query,
    "op3_permutation_index": neighbours.query,
    "op4_toxicity": toxicity.query,
    "op5_pack": packing.query,
    "op6_shard": sharding.query,
    "op7_token_rollup": rollup.query,
    "op8_ngram_jaccard_join": jaccard.query,
    "op9_pii": pii.query,
    "op10_exact_dedup": exact_dedup.query,
    "op11_merkle_manifest": merkle.query,
    "op12_cross_tokenizer": alignment.query,
    "op13_fingerprints": fingerprints.query,
}
ORACLE = {
    "op8_ngram_jaccard_join": jaccard.ORACLE,
    "op9_pii": pii.ORACLE,
    "op10_exact_dedup": exact_dedup.ORACLE,
    "op11_merkle_manifest": merkle.ORACLE,
}
