"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import chat, decontaminate, hamming, jaccard, language, licenses, packing, pii, sharding, wrappers

QUERIES = {
    "op1_chat_formatting": chat.op1_chat_formatting,
    "op2_language_id": language.op2_language_id,
    "op3_shard_lookup": sharding.op3_shard_lookup,
    "op4_best_fit_packing": packing.op4_best_fit_packing,
    "op5_pii": pii.op5_pii,
    "op6_jaccard_join": jaccard.op6_jaccard_join,
    "op7_license_scan": licenses.op7_license_scan,
    "op8_decontamination": decontaminate.op8_decontamination,
    "op9_hamming_top_k": hamming.op9_hamming_top_k,
    "op10_html_extraction": wrappers.op10_html_extraction,
}
ORACLE_SQL = {
    "op1_chat_formatting": chat.ORACLE,
    "op3_shard_lookup": sharding.ORACLE,
    "op6_jaccard_join": jaccard.ORACLE,
    "op7_license_scan": licenses.ORACLE,
    "op8_decontamination": decontaminate.ORACLE,
    "op9_hamming_top_k": hamming.ORACLE,
}
