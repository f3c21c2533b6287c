"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import bpe_reuse, decontaminate, exact_dedup, language_id, licenses, line_dedup, lm_scoring, near_dedup, repeats, token_files

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_token_files": token_files.op4_token_files,
    "op5_repeats": repeats.op5_repeats,
    "op6_language_id": language_id.op6_language_id,
    "op7_bpe_reuse": bpe_reuse.op7_bpe_reuse,
    "op8_near_dedup": near_dedup.op8_near_dedup,
    "op9_lm_scoring": lm_scoring.op9_lm_scoring,
    "op10_licenses": licenses.op10_licenses,
}
SQL = {"op1_exact_dedup": exact_dedup.SQL, "op2_decontaminate": decontaminate.SQL, "op3_line_dedup": line_dedup.SQL}
