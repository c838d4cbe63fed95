"""The queries of this subpackage, with the SQL for those that SQL can express."""

from __future__ import annotations

from corpusloom.llm import chat, decontamination, exact_dedup, language, mixing, quality, simhash, substring_dedup, tokens, toxicity

QUERIES = {
    "op1_chat_format": chat.op1_chat_format,
    "op2_language_id": language.op2_language_id,
    "op3_token_counts": tokens.op3_token_counts,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_substring_dedup": substring_dedup.op5_substring_dedup,
    "op6_quality": quality.op6_quality,
    "op7_mix_sources": mixing.op7_mix_sources,
    "op8_decontaminate": decontamination.op8_decontaminate,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_simhash": simhash.op10_simhash,
}

ORACLE_SQL = {
    "op1_chat_format": chat.OP1_SQL,
    "op7_mix_sources": mixing.OP7_SQL,
    "op8_decontaminate": decontamination.OP8_SQL,
    "op9_exact_dedup": exact_dedup.OP9_SQL,
}
