"""The training-data queries and their SQL, added to the library's by the driver entry."""

from __future__ import annotations

from . import attention_lm, bpe_prefix, exact_dedup, langid, merkle, packing, repair, sharding, tgm_join, toxicity

QUERIES = {
    "op1_tgm_jaccard": tgm_join.op1_tgm_jaccard,
    "op2_ftrl_toxicity": toxicity.op2_ftrl_toxicity,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_merkle_fingerprint": merkle.op4_merkle_fingerprint,
    "op5_repair_tokens": repair.op5_repair_tokens,
    "op6_prefix_bpe": bpe_prefix.op6_prefix_bpe,
    "op7_attention_lm": attention_lm.op7_attention_lm,
    "op8_crf_langid": langid.op8_crf_langid,
    "op9_best_fit_packing": packing.op9_best_fit_packing,
    "op10_label_shards": sharding.op10_label_shards,
}

ORACLE_SQL = {
    "op3_exact_dedup": exact_dedup.ORACLE_SQL,
    "op4_merkle_fingerprint": merkle.ORACLE_SQL,
}
