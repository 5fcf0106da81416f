"""From documents to packed token rows: each stage works on all that the one before it kept.

The stages: documents predicted toxic go; one document of each near-duplicate component stays; documents that
overlap a benchmark item go; the sources are mixed to target weights; the mix is packed as token ids.
SQL cannot express the trained classifier, the signatures, the seeded permutations and the tokenizer, so there is no
ORACLE_SQL; the tests hold the stages against brute-force versions.

Defined results: every row is judged by itself, whatever its doc_id, which may be null or repeated. A null, empty or
wordless text is not toxic by itself (it has the score of a text without words), is no near duplicate, is clean, has no
words to mix and so leaves with the mixing stage. Of equal or near-equal rows the one with the smallest doc_id stays
(null last; of one doc_id the one with the smallest xxhash64 of the text). Texts of any length are judged whole. Without labels of both
classes nothing is toxic, without a benchmark nothing is contaminated, and an empty table gives no rows. Further columns of
documents pass through all stages but the last, whatever their names (`_row` and `_mixed` are taken); n_chars, where
there is one, follows the mixed text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from cohortspark.llm import common, decontamination, mixing, near_dups, packing, toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity.pipeline_stage),
    ("near_dedup", near_dups.pipeline_stage),
    ("decontamination", decontamination.pipeline_stage),
    ("mixing", mixing.pipeline_stage),
    ("packing", packing.pipeline_stage),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; what a stage returns is written and read again as the next one's input, and the tables
    behind it are removed."""
    docs = common.table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, common.settled(partial(stage, spark, docs, sf_dir), f"stage-{name}")
        if k:
            common.discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
