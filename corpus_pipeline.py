"""Corpus pipeline: documents through the stages in order, each written and read again.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame. All but the last return the columns of ``documents``; the last gives the
packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from formlake.llm.common import staged, table
from formlake.llm.decontaminate import drop_contaminated
from formlake.llm.language_id import accept_languages
from formlake.llm.near_dedup import drop_near_duplicates
from formlake.llm.packing import packed_documents
from formlake.llm.suffix_dedup import drop_repeats


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go."""
    return accept_languages(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return drop_near_duplicates(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings that stand in several places are cut out of the texts."""
    return drop_repeats(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in the training sequences."""
    return packed_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

# Approximate matching and trained models have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
