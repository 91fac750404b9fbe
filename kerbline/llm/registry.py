"""The operators' queries and the SQL that checks them."""

from __future__ import annotations

from kerbline.llm import (
    op1_pitman_yor,
    op2_winnowing,
    op3_simhash,
    op4_html,
    op5_token_counts,
    op6_quality,
    op7_language,
    op8_bpe,
    op9_secrets,
    op10_packing,
    op11_tiktoken,
    op12_divergence,
    op13_hard_negatives,
)

MODULES = [
    op1_pitman_yor,
    op2_winnowing,
    op3_simhash,
    op4_html,
    op5_token_counts,
    op6_quality,
    op7_language,
    op8_bpe,
    op9_secrets,
    op10_packing,
    op11_tiktoken,
    op12_divergence,
    op13_hard_negatives,
]


def queries() -> dict:
    return {module.NAME: module.query for module in MODULES}


def oracle_sql() -> dict[str, str]:
    return {m.NAME: m.SQL for m in MODULES if getattr(m, "SQL", None)}
