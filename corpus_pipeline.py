"""The corpus pipeline: documents -> clean, unique, packed training sequences.

Defined results: documents of under 20 words, null and empty ones among them,
fall to the quality rules, so the later stages never meet them; rows without a
doc_id pass through every stage and name no group; of repeated rows, equal
texts and near copies the least doc_id stays (rows that share it stay
together); texts of any length are worked on whole; of pieces that fit equally
well packing takes the one that comes first; an empty table gives an empty one.
All columns of documents are kept up to the last stage, and the stages' own have
prefixes, so that extra ones cannot clash.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from texloom.llm import decontam, linededup, nearcopies, packing, quality
from texloom.llm.shared import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the isolation forest keep."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their host's boilerplate lines."""
    return linededup.drop_boilerplate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: SimHash and MinHash candidates with a verified similarity of 0.8 or more."""
    return nearcopies.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences; no longer documents."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", pack)]

#: No SQL: the isolation forest and SimHash components have none. tests/llm/ holds the brute-force comparison.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES applied to documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
