"""Registered queries: each applies one operator, with its production
parameters, to the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgelake.llm import (
    collocate, decontaminate, hardneg, langid, licenses, lines, minhash, mixing, quality, simhash, tokencount, urltree,
    warc,
)
from lodgelake.llm.common import table
from lodgelake.llm.oracle_sql import SQL

import corpus_pipeline


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.label_documents(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op6_url_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urltree.judge(table(spark, sf_dir, "pages")).drop("purity")


def op7_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of(found["fp"]).alias("fingerprint"), "component_id")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.replicate(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fiftieth row is an anchor; labels of every seventh are moved on first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("id") % 50 == 0)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocate.collocations(table(spark, sf_dir, "documents"))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality, op2_decontaminate, op3_licenses, op4_warc, op5_language, op6_url_tree, op7_line_rules,
        op8_simhash, op9_token_counts, op10_mixing, op11_hard_negatives, op12_collocations, op13_minhash,
    )
} | {"pipeline": corpus_pipeline.run}

ORACLE: dict[str, str] = SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
