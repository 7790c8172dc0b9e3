"""Corpus pipeline: five stages, each over all that its predecessor kept.

A stage is called as f(spark, docs, sf_dir) and returns a DataFrame; the runner
writes it as Parquet into the shared folder and the next stage reads that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodgelake.llm import decontaminate, lines, mixing, quality, simhash
from lodgelake.llm.common import stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the line labels keep.  The lines are
    learnt from the whole table: ``docs`` have lost their boilerplate, so they
    hold one class only."""
    labels = table(spark, sf_dir, "labels")
    whole = table(spark, sf_dir, "documents") if lines.has_classes(labels) else None
    return lines.keep_content(docs, labels, whole)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs, shingle=simhash.SHINGLE, bits=simhash.BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold benchmark passages."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: documents replicated to their source's rate, in random order."""
    return mixing.replicate(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing", source_mixing),
]

#: The classifier and the line labels are learnt: no SQL gives these rows; the
#: tests hold run() against the stages' brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
