"""The training-data queries and their DuckDB twins, one of each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontamination, exact_topk, language_id, licenses, mixing, near_dups, oracles, packing, substrings, token_counts, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": language_id.op1_language_id,
    "op2_substring_dedup": substrings.op2_substring_dedup,
    "op3_decontamination": decontamination.op3_decontamination,
    "op4_near_duplicates": near_dups.op4_near_duplicates,
    "op5_license_scan": licenses.op5_license_scan,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_packing": packing.op7_packing,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_exact_topk": exact_topk.op9_exact_topk,
    "op10_mixing": mixing.op10_mixing,
}

ORACLES: dict[str, str] = {
    "op2_substring_dedup": oracles.OP2_SQL,
    "op3_decontamination": oracles.op3_sql(),
    "op4_near_duplicates": oracles.OP4_SQL,
    "op5_license_scan": licenses.OP5_SQL,
    "op9_exact_topk": exact_topk.OP9_SQL,
}
