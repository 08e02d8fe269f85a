"""Registered queries of the operators and of the pipeline, and their DuckDB SQL."""

from __future__ import annotations

from intakeyard.llm import (
    alignment,
    byte_bpe,
    decontaminate,
    exact_dedup,
    hard_negatives,
    line_templates,
    near_dedup,
    ngram_join,
    quality,
    secret_scan,
    suffix_dedup,
    token_counts,
    toxicity,
)

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_near_dedup": near_dedup.op3_near_dedup,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_byte_bpe": byte_bpe.op5_byte_bpe,
    "op6_secret_scan": secret_scan.op6_secret_scan,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
    "op10_line_templates": line_templates.op10_line_templates,
    "op11_ngram_join": ngram_join.op11_ngram_join,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_alignment": alignment.op13_alignment,
}

ORACLE = {
    "op2_exact_dedup": exact_dedup.ORACLE,
    "op6_secret_scan": secret_scan.ORACLE,
    "op10_line_templates": line_templates.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
}
