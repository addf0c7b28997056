"""Registered queries of the subpackage and their DuckDB counterparts."""

from __future__ import annotations

from airshed.llm import conversation_repair, decontaminate, language_id, line_dedup, mixing, near_dedup, pii, quality_classifier, quality_rules, source_audit, token_ids, toxicity, warc

QUERIES = {
    "op10_token_ids": token_ids.q_token_ids,
    "op1_decontaminate": decontaminate.q_decontaminate,
    "op2_pii": pii.q_pii,
    "op9_language_id": language_id.q_language_id,
    "op5_warc": warc.q_warc,
    "op7_toxicity": toxicity.q_toxicity,
    "op3_near_dedup": near_dedup.q_near_dedup,
    "op4_quality_rules": quality_rules.q_quality_rules,
    "op6_mix_sources": mixing.q_mix,
    "op8_line_dedup": line_dedup.q_line_dedup,
    "op11_conversation_repair": conversation_repair.q_conversation_repair,
    "op12_quality_classifier": quality_classifier.q_quality_classifier,
    "op13_source_audit": source_audit.q_source_audit,
}

ORACLE_SQL = {
    "op5_warc": warc.ORACLE,
    "op3_near_dedup": near_dedup.ORACLE,
    "op6_mix_sources": mixing.ORACLE,
    "op8_line_dedup": line_dedup.ORACLE,
    "op11_conversation_repair": conversation_repair.ORACLE,
    "op13_source_audit": source_audit.ORACLE,
}
