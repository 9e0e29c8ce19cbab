"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from . import decontaminate, linededup, maxent, neardup, packing, passages, quality, sharding, tokencount, urlrules


def queries():
    return {
        "op1_lm_scoring": maxent.op1_lm_scoring,
        "op2_near_dedup": neardup.op2_near_dedup,
        "op3_packing": packing.op3_packing,
        "op4_sharding": sharding.op4_sharding,
        "op5_quality_rules": quality.op5_quality_rules,
        "op6_token_counts": tokencount.op6_token_counts,
        "op7_line_dedup": linededup.op7_line_dedup,
        "op8_decontamination": decontaminate.op8_decontamination,
        "op9_suffix_dedup": passages.op9_suffix_dedup,
        "op10_url_filters": urlrules.op10_url_filters,
    }


def oracle_sql():
    return {"op2_near_dedup": neardup.OP2_SQL, "op7_line_dedup": linededup.OP7_SQL, "op10_url_filters": urlrules.OP10_SQL}
