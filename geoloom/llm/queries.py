"""The queries of this subpackage and their SQL, as ``__spark_entry__.py`` registers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import language_id, near_dedup, packing, pieces, quality_classifier, quality_rules, substring_dedup, suffix_dedup, token_files, topk

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "quality_ablations": quality_rules.quality_ablations,
    "op3_topk": topk.op3_topk,
    "op4_token_files": token_files.op4_token_files,
    "op5_quality_classifier": quality_classifier.op5_quality_classifier,
    "op6_pieces": pieces.op6_pieces,
    "op7_language_id": language_id.op7_language_id,
    "op8_packing": packing.op8_packing,
    "op9_near_dedup": near_dedup.op9_near_dedup,
    "op10_suffix_dedup": suffix_dedup.op10_suffix_dedup,
}
SQL: dict[str, str] = {"op2_quality_rules": quality_rules.OP2_SQL, "quality_ablations": quality_rules.ABLATIONS_SQL, "op3_topk": topk.OP3_SQL}
