"""Reading order: what would be a stack machine over a document's blocks is three windowed values.

The block that a new one relates to is always the latest that is no footnote,
and a heading's peer the latest heading, so nothing needs a stack. Documents
that begin with a footnote keep their relations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..schema import FOOTNOTE, SORTABLE, TITLE_LIKE


def reading_order(blocks: DataFrame) -> DataFrame:
    """doc_id, type, from_id, to_id: identical, adj, sub, peer and explicit-cite relations of sortable blocks."""
    before = Window.partitionBy("doc_id").orderBy("ann_pos").rowsBetween(Window.unboundedPreceding, -1)
    kind = F.when(F.col("category").isin(TITLE_LIKE), "title").when(F.col("category") == FOOTNOTE, "fn").otherwise("text")
    latest = lambda value, when: F.last(F.when(when, F.col(value)), ignorenulls=True).over(before)
    seen = blocks.where(F.col("category").isin(SORTABLE)).select("doc_id", "block_id", "ann_pos", "parent_block", kind.alias("kind"))
    seen = seen.select("*", latest("block_id", F.col("kind") != "fn").alias("top_id"), latest("kind", F.col("kind") != "fn").alias("top_kind"), latest("block_id", F.col("kind") == "title").alias("last_title"))
    relation = (
        F.when(F.col("parent_block") == F.col("top_id"), "identical")
        .when((F.col("kind") == "text") & (F.col("top_kind") == "text"), "adj")
        .when((F.col("kind") == "text") & (F.col("top_kind") == "title"), "sub")
        .when((F.col("kind") == "title") & F.col("last_title").isNotNull(), "peer")
        .when((F.col("kind") == "fn") & F.col("top_id").isNotNull(), "explicit-cite")
    )
    found = seen.withColumn("type", relation).where("type is not null")
    return found.select("doc_id", "type", F.col("block_id").alias("from_id"), F.when(F.col("type") == "peer", F.col("last_title")).otherwise(F.col("top_id")).alias("to_id"))


def type_counts(orders: DataFrame) -> DataFrame:
    return orders.groupBy("type").agg(F.count("*").alias("n_relations"), F.countDistinct("doc_id").alias("n_docs"))


def relation_centres(orders: DataFrame, blocks: DataFrame, first_page: int, width: float | None = None) -> DataFrame:
    """doc_id, type, from/to ids and box centres of relations on a page; with a width also those that reach the next page, which lies `width` to the right."""
    pages = [first_page] if width is None else [first_page, first_page + 1]
    shown = blocks.where(F.col("page_index").isin(pages))
    shift = F.when(F.col("page_index") > first_page, F.lit(float(width or 0))).otherwise(0.0)
    end = lambda side: shown.select("doc_id", F.col("block_id").alias(f"{side}_id"), ((F.col("x0") + F.col("x1")) / 2 + shift).alias(f"{side}_x"), ((F.col("y0") + F.col("y1")) / 2).alias(f"{side}_y"))
    return orders.join(end("from"), ["doc_id", "from_id"]).join(end("to"), ["doc_id", "to_id"]).select("doc_id", "type", "from_id", "to_id", "from_x", "from_y", "to_x", "to_y")
