"""The queries op1 to op13: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import spread
from . import chat, decontam, html_text, licenses, linededup, packing, quality, search, simhash, tokenstore, toxicity, veccodes, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    found = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(found) if name == "documents" else found


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.drop_boilerplate(_table(spark, sf_dir, "documents"), counted=True).select("doc_id", "source", "text", "n_lines", "n_dropped")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.match(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", trap), (-7, 1, "assistant", trap)], table.schema)
    return chat.read_chats(chat.format_chats(table.union(more)))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(_table(spark, sf_dir, "pages"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenstore.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), "word", 2)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return veccodes.compress(_table(spark, sf_dir, "embeddings"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.score_documents(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_line_dedup, op3_decontamination, op4_warc, op5_simhash, op6_chat_format, op7_html_text, op8_packing, op9_token_store, op10_licenses, op11_vector_codes, op12_toxicity, op13_lexical_search)}
