"""The registered queries of this folder, and their SQL where SQL can express them."""

from __future__ import annotations

from veilframe.llm import embedding_join, mixing, oracles, packing, pseudonyms, quality_model, quality_rules, secrets, sharding, shingle_join, toxicity


def queries() -> dict:
    return {
        "op1_secret_scan": secrets.op1_secret_scan,
        "op2_shingle_join": shingle_join.op2_shingle_join,
        "op3_embedding_join": embedding_join.op3_embedding_join,
        "op4_toxicity": toxicity.op4_toxicity,
        "op5_mix_sources": mixing.op5_mix_sources,
        "op6_quality_rules": quality_rules.op6_quality_rules,
        "op7_shuffle_shards": sharding.op7_shuffle_shards,
        "op8_pack_windows": packing.op8_pack_windows,
        "op9_pseudonyms": pseudonyms.op9_pseudonyms,
        "op10_quality": quality_model.op10_quality,
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracles.ORACLES)
