"""A corpus made ready for training, in stages; each stage reads what the one before it wrote.

Defined results, of every stage: an empty table stays empty, and all but the last stage return the columns of their input,
whatever extra ones there are and however they are named. Null and empty texts have no words, so the first stage rejects
them; where a later stage is given them, they match, link and hold nothing. Rows that repeat under one key are one document,
kept or dropped together. A null key is linked with nothing but equal texts, so its rows stay. Long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import common, decontamination, near_duplicates, pii, quality_rules, source_mixing


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, or come from a rejected host, go."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8 or more."""
    return near_duplicates.keep_first(docs, k=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a benchmark item leaks into go."""
    return decontamination.clean(docs, common.table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked; all documents stay."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by the budgets of their sources, once for each epoch that takes them."""
    return source_mixing.mixed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("pii", mask_personal_data),
    ("source_mixing", mix_sources),
]

#: SQL can't express signatures, embeddings and parsers; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written to the shared folder and read back."""
    docs = common.table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = common.cut(docs, name)
    return docs
