"""Queries of the training-data operators and, where SQL can say the same, their DuckDB SQL."""

from __future__ import annotations

from keymend.llm.brown_lm import op3_brown_lm
from keymend.llm.exact_dedup import OP4_SQL, op4_exact_dedup
from keymend.llm.minhash_forest import op1_minhash_forest
from keymend.llm.pack import op8_pack
from keymend.llm.pii import op7_pii
from keymend.llm.quality_classifier import op9_quality_classifier
from keymend.llm.quality_rules import op6_quality_rules
from keymend.llm.source_mix import OP5_SQL, op5_source_mix
from keymend.llm.substring_dedup import op2_substring_dedup
from keymend.llm.suffix_dedup import op10_suffix_dedup

QUERIES = {
    "op1_minhash_forest": op1_minhash_forest,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_brown_lm": op3_brown_lm,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_source_mix": op5_source_mix,
    "op6_quality_rules": op6_quality_rules,
    "op7_pii": op7_pii,
    "op8_pack": op8_pack,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_suffix_dedup": op10_suffix_dedup,
}
SQL = {
    "op4_exact_dedup": OP4_SQL,
    "op5_source_mix": OP5_SQL,
}
