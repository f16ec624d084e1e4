"""Queries of this subpackage by name, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from . import (chat_format, decontaminate, embedding_dedup, language_id, license_scan, lm_score, minhash_dedup, pack, periodic_runs, pii,
               ranked_search, sharding, substring_dedup)

QUERIES = {
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op2_chat_format": chat_format.op2_chat_format,
    "op3_lm_score": lm_score.op3_lm_score,
    "op4_pack": pack.op4_pack,
    "op5_license_scan": license_scan.op5_license_scan,
    "op6_language_id": language_id.op6_language_id,
    "op7_minhash_dedup": minhash_dedup.op7_minhash_dedup,
    "op8_embedding_dedup": embedding_dedup.op8_embedding_dedup,
    "op9_pii": pii.op9_pii,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op11_sharding": sharding.op11_sharding,
    "op12_ranked_search": ranked_search.op12_ranked_search,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}

ORACLE_SQL = {
    "op1_substring_dedup": substring_dedup.ORACLE,
    "op2_chat_format": chat_format.ORACLE,
    "op5_license_scan": license_scan.ORACLE,
    "op7_minhash_dedup": minhash_dedup.ORACLE,
    "op8_embedding_dedup": embedding_dedup.ORACLE,
    "op11_sharding": sharding.ORACLE,
    "op12_ranked_search": ranked_search.ORACLE,
    "op13_periodic_runs": periodic_runs.ORACLE,
}
