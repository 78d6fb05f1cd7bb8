"""Quality reports of annotated documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def overlaps(blocks: DataFrame) -> DataFrame:
    """doc_id, page_index, a_id, b_id, overlap: pairs of boxes of a page that meet, each once.

    A page is a grid whose cells are twice as wide and high as its boxes are on average, so that a box lies in few cells; a box has
    a row for each cell that it touches, and only boxes of one cell are compared. Where several cells hold a pair, the one
    with the lower left corner of what both share owns it. Pages of any number of boxes are cut into many keys.
    """
    lo, hi = lambda a: F.least(f"{a}0", f"{a}1"), lambda a: F.greatest(f"{a}0", f"{a}1")
    boxes = blocks.select("doc_id", "page_index", "block_id", "x0", "y0", "x1", "y1").where("x0 is not null and x1 is not null and y0 is not null and y1 is not null")
    page = boxes.groupBy("doc_id", "page_index").agg(F.count("*").alias("_n"), *(f(x(a)).alias(f"_{k}{a}") for a in "xy" for k, f, x in (("from", F.min, lo), ("to", F.max, hi))), *(F.avg(hi(a) - lo(a)).alias(f"_mean{a}") for a in "xy"))
    for a in "xy":
        extent = F.col(f"_to{a}") - F.col(f"_from{a}")
        cells = F.least(F.when(F.col(f"_mean{a}") > 0, F.ceil(extent / (2 * F.col(f"_mean{a}")))).otherwise(F.ceil(F.sqrt("_n"))), F.col("_n"))
        page = page.withColumn(f"_cells{a}", F.greatest(cells, F.lit(1))).withColumn(f"_step{a}", F.when(extent > 0, extent / F.col(f"_cells{a}")).otherwise(1.0))
    cell = lambda a, end: F.least(F.floor((end(a) - F.col(f"_from{a}")) / F.col(f"_step{a}")), F.col(f"_cells{a}") - 1).cast("long")
    placed = boxes.join(page, ["doc_id", "page_index"]).select(*boxes.columns, *(cell(a, end).alias(f"_{k}{a}") for a in "xy" for k, end in (("first", lo), ("last", hi))))
    celled = placed.withColumn("_cx", F.explode(F.sequence("_firstx", "_lastx"))).withColumn("_cy", F.explode(F.sequence("_firsty", "_lasty")))
    names = ("block_id", "x0", "y0", "x1", "y1", "_firstx", "_firsty")
    side = lambda s: celled.select("doc_id", "page_index", "_cx", "_cy", *(F.col(c).alias(f"{s}_{c}") for c in names))
    meet = (F.col("a_block_id") < F.col("b_block_id")) & (F.col("a_x0") <= F.col("b_x1")) & (F.col("b_x0") <= F.col("a_x1")) & (F.col("a_y0") <= F.col("b_y1")) & (F.col("b_y0") <= F.col("a_y1"))
    owner = (F.col("_cx") == F.greatest("a__firstx", "b__firstx")) & (F.col("_cy") == F.greatest("a__firsty", "b__firsty"))
    area = (F.least("a_x1", "b_x1") - F.greatest("a_x0", "b_x0")) * (F.least("a_y1", "b_y1") - F.greatest("a_y0", "b_y0"))
    return side("a").join(side("b"), ["doc_id", "page_index", "_cx", "_cy"]).where(meet & owner).select("doc_id", "page_index", F.col("a_block_id").alias("a_id"), F.col("b_block_id").alias("b_id"), area.alias("overlap"))


def page_overlap(blocks: DataFrame) -> DataFrame:
    return overlaps(blocks).groupBy("doc_id", "page_index").agg(F.sum("overlap").alias("overlap"), F.count("*").alias("n_pairs"))


def page_quality(blocks: DataFrame) -> DataFrame:
    """doc_id, page ('total' for all), num_blocks, area, overlap, ratio."""
    area = F.abs((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")))
    pages = blocks.groupBy("doc_id", "page_index").agg(F.count("*").alias("num_blocks"), F.sum(area).alias("area"))
    both = pages.join(page_overlap(blocks), ["doc_id", "page_index"], "left").fillna(0.0, ["overlap"])
    rolled = both.rollup("doc_id", "page_index").agg(F.sum("num_blocks").alias("num_blocks"), F.sum("area").alias("area"), F.sum("overlap").alias("overlap")).where("doc_id is not null")
    return rolled.select("doc_id", F.coalesce(F.col("page_index").cast("string"), F.lit("total")).alias("page"), "num_blocks", "area", "overlap", F.when(F.col("area") == 0, 0.0).otherwise(F.col("overlap") / F.col("area")).alias("ratio"))


def category_quality(blocks: DataFrame, mentions: DataFrame) -> DataFrame:
    """doc_id, category ('Total' for all), geometry_count, reading_count, missing_rate; figures have no mentions to miss.

    blocks: doc_id, category, parent_block; mentions: doc_id, category, a row each.
    """
    shown = blocks.where("category <> 'Figure'").groupBy("doc_id", "category").agg(F.count_if(F.col("parent_block").isNull()).alias("geometry_count"))
    read = mentions.where("category <> 'Figure'").groupBy("doc_id", "category").agg(F.count("*").alias("reading_count"))
    both = shown.join(read, ["doc_id", "category"], "full").fillna(0, ["geometry_count", "reading_count"])
    rolled = both.rollup("doc_id", "category").agg(F.sum("geometry_count").alias("geometry_count"), F.sum("reading_count").alias("reading_count")).where("doc_id is not null")
    missing = F.when(F.col("reading_count") == 0, 0.0).otherwise(1 - F.col("geometry_count") / F.col("reading_count"))
    return rolled.select("doc_id", F.coalesce("category", F.lit("Total")).alias("category"), "geometry_count", "reading_count", missing.alias("missing_rate"))


def report_header(blocks: DataFrame, compat: bool = False) -> DataFrame:
    """doc_id, num_pages; compat: the last page's index from 0 instead of a count."""
    return blocks.groupBy("doc_id").agg((F.max("page_index") + (0 if compat else 1)).alias("num_pages"))
