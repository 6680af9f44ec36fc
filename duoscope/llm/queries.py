"""Registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from duoscope.llm import oracle_sql as oracle_sql_of
from duoscope.llm import (
    crf_quality, decontaminate, hard_negatives, language_id, mixing, near_dedup, order_minhash, secrets, shards,
    source_audit, suffix_tree, token_files, url_rules,
)


def queries() -> dict:
    return {
        "op1_language_id": language_id.op1_language_id,
        "op2_mixing": mixing.op2_mixing,
        "op3_secrets": secrets.op3_secrets,
        "op4_order_minhash": order_minhash.op4_order_minhash,
        "op5_quality": crf_quality.op5_quality,
        "op6_decontaminate": decontaminate.op6_decontaminate,
        "op7_shards": shards.op7_shards,
        "op8_token_files": token_files.op8_token_files,
        "op9_near_dedup": near_dedup.op9_near_dedup,
        "op10_url_rules": url_rules.op10_url_rules,
        "op11_hard_negatives": hard_negatives.op11_hard_negatives,
        "op12_source_audit": source_audit.op12_source_audit,
        "op13_suffix_tree": suffix_tree.op13_suffix_tree,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_mixing": oracle_sql_of.MIXING,
        "op3_secrets": oracle_sql_of.SECRETS,
        "op6_decontaminate": oracle_sql_of.DECONTAMINATION,
        "op7_shards": oracle_sql_of.SHARDS,
        "op9_near_dedup": oracle_sql_of.NEAR_DUPLICATES,
        "op10_url_rules": url_rules.OP10_SQL,
        "op11_hard_negatives": hard_negatives.OP11_SQL,
        "op12_source_audit": source_audit.OP12_SQL,
    }
