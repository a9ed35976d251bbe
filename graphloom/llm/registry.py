"""The queries of this subpackage, by name, and the DuckDB SQL of those that SQL can express."""

from . import exact_dedup, language_id, minhash_dedup, mixing, packing, quality, sharding, substring_dedup, topk_search, toxicity

QUERIES = {
    "op1_sharding": sharding.op1_sharding,
    "op2_quality_classifier": quality.op2_quality_classifier,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_substring_dedup": substring_dedup.op4_substring_dedup,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_packing": packing.op6_packing,
    "op7_minhash_near_dedup": minhash_dedup.op7_minhash_near_dedup,
    "op8_language_id": language_id.op8_language_id,
    "op9_topk_search": topk_search.op9_topk_search,
    "op10_mixing": mixing.op10_mixing,
}

SQL = {
    "op4_substring_dedup": substring_dedup.OP4_SQL,
    "op5_exact_dedup": exact_dedup.OP5_SQL,
    "op7_minhash_near_dedup": minhash_dedup.OP7_SQL,
    "op9_topk_search": topk_search.OP9_SQL,
}
