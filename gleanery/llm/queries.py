"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from . import (
    op1_packing,
    op2_quality,
    op3_exact_dedup,
    op4_simhash,
    op5_url_filter,
    op6_line_dedup,
    op7_fertility,
    op8_brown_lm,
    op9_token_rollup,
    op10_mixing,
)

_MODULES = {
    "op1_packing": op1_packing,
    "op2_quality": op2_quality,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_simhash": op4_simhash,
    "op5_url_filter": op5_url_filter,
    "op6_line_dedup": op6_line_dedup,
    "op7_fertility": op7_fertility,
    "op8_brown_lm": op8_brown_lm,
    "op9_token_rollup": op9_token_rollup,
    "op10_mixing": op10_mixing,
}


def queries():
    return {name: module.query for name, module in _MODULES.items()}


def oracle_sql():
    return {name: module.ORACLE for name, module in _MODULES.items() if hasattr(module, "ORACLE")}
