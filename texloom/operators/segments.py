"""Mentions that need a parsed document: headings, lists, equations and paragraphs, from its segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import tex as T
from ..schema import LISTS, MATH_ENVS, SECTIONS, TEXT_ENVS


def categorised(segments: DataFrame) -> DataFrame:
    """segments (rows of parse.parse_segments over main contents) with category, null for what is no mention.

    Headings count at the top level only; lists and equations at any depth, but not within one another, as captured
    environments are one segment; text where every environment around it is a text environment.
    """
    before = Window.partitionBy("doc_id").orderBy("seg_pos").rowsBetween(Window.unboundedPreceding, -1)
    closed = ~F.col("name").isin(TEXT_ENVS)
    step = F.when((F.col("kind") == "begin") & closed, 1).when((F.col("kind") == "end") & closed, -1).when(F.col("name") == "{", 1).when(F.col("name") == "}", -1).otherwise(0)
    open_ = F.coalesce(F.sum(step).over(before), F.lit(0))
    kind = (
        F.when((F.col("kind") == "command") & (F.col("depth") == 0) & F.col("name").isin(SECTIONS), "Title")
        .when((F.col("kind") == "captured") & F.col("name").isin(LISTS), "List")
        .when((F.col("kind") == "captured") & F.col("name").isin([*MATH_ENVS, "displaymath"]), "Equation")
        .when((F.col("kind") == "text") & (open_ == 0) & F.col("text").rlike(r"(?U)\S"), F.when(T.is_text_eq(F.col("text")), "Text-EQ").otherwise("Text"))
    )
    return segments.withColumn("category", kind)


def segment_mentions(segments: DataFrame) -> DataFrame:
    """doc_id, category, idx, source_code of the mentions among segments."""
    found = categorised(segments.where("error is null")).select("doc_id", "seg_pos", "category", F.col("text").alias("source_code")).where("category is not null")
    place = Window.partitionBy("doc_id", "category").orderBy("seg_pos")
    return found.select("doc_id", "category", (F.row_number().over(place) - 1).cast("long").alias("idx"), "source_code")
