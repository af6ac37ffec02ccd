"""A corpus pipeline: language ID, quality rules, near-dedup, suffix-array dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns the columns of documents, the last one the packed
pieces.  ``run`` writes every stage's rows to the shared folder and goes on from there; what a stage wrote on
the way, and its predecessor's rows, are deleted then.

Cases, in every stage: an empty table gives no rows; further columns are left out; texts of any length are
treated whole; rows that repeat a doc_id are kept or dropped alike, and near-dedup keeps all rows of the
document it keeps.  A null text has no letters, so language ID drops it; so are empty texts.  A null doc_id
passes every stage that judges the text alone, is never a duplicate, and loses nothing to suffix dedup.  A null
lang is filled in; without any label nothing can be judged and all documents stay.  Ties go to the smaller doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm import language_id, near_dedup, packing, quality_rules, suffix_dedup
from geoloom.llm.common import dropped, settled, table
from geoloom.llm.tokens import default_tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


#: A text of JUDGED symbols or more goes if its best language takes over MOST_BITS a symbol.  On sf0.1 the 9740
#: texts of that length take 5.8 at most; random letters take 10.5 and more, as does a script that no sample holds.
JUDGED, MOST_BITS = 100, 8.0


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus's own labels teach, with lang as the parse has it.

    Where the corpus has no label at all, nothing is judged and only texts without letters go.
    Otherwise a text without letters goes, and so does one of ``JUDGED`` symbols that no language parses in ``MOST_BITS`` a
    symbol.  On a conflict the parse overrules the label; a shorter text keeps its label, a missing one is filled in.
    """
    found = language_id.identified(docs.select(COLUMNS), F.col("doc_id").isNotNull())
    judged = F.col("symbols") >= JUDGED
    known = found.where(F.col("text").rlike("\\p{L}") & ~(judged & (F.col("bits") > MOST_BITS)))
    return known.withColumn("lang", F.when(judged & (F.col("lang_pred") != language_id.UNKNOWN), F.col("lang_pred")).otherwise(F.coalesce("lang", "lang_pred"))).select(COLUMNS)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps."""
    return quality_rules.passing(docs.select(COLUMNS))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each class; documents without doc_id stay."""
    leaders = near_dedup.classes(docs).where("doc_id = class_id").select("doc_id").distinct()
    named = docs.select(COLUMNS).where(F.col("doc_id").isNotNull()).join(leaders, "doc_id", "left_semi")
    return named.unionByName(docs.select(COLUMNS).where(F.col("doc_id").isNull()))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document with a smaller doc_id holds."""
    return suffix_dedup.deduplicated(docs.select(COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences."""
    return packing.packed(docs, default_tokenizer())


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", apply_quality_rules),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeated_passages),
    ("packing", pack_sequences),
]
#: SQL cannot express the stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        done, path = settled(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name)
        dropped(spark, last)  # the predecessor's rows
        docs, last = done, [path]
    return STAGES[-1][1](spark, docs, sf_dir)
