"""Boxes and layout metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..schema import LAYOUT_KEYS, ONE_COLUMN, POINTS_PER_INCH, PPI
from .colour import LOG_TAG


def width(b: str = "") -> Column:
    return F.col(f"{b}x1") - F.col(f"{b}x0")


def height(b: str = "") -> Column:
    return F.col(f"{b}y1") - F.col(f"{b}y0")


def enclosing(boxes: DataFrame, keys: list[str]) -> DataFrame:
    """The least box around all of a group's."""
    return boxes.groupBy(*keys).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def merged_fragments(fragments: DataFrame) -> DataFrame:
    """Fragments of one mention on one page that overlap in sequence, as one box; parent_fragment is the mention's one before.

    fragments: doc_id, category, idx, page_index, col, ann_pos and a box. A fragment joins its group if it overlaps the box that the group has grown to.
    """
    items = F.array_sort(F.collect_list(F.struct("page_index", "col", "ann_pos", "x0", "y0", "x1", "y1")))
    grouped = fragments.groupBy("doc_id", "category", "idx").agg(items.alias("l"))

    def meets(a: Column, b: Column) -> Column:
        return (a["page_index"] == b["page_index"]) & (F.least(a["x1"], b["x1"]) > F.greatest(a["x0"], b["x0"])) & (F.least(a["y1"], b["y1"]) > F.greatest(a["y0"], b["y0"]))

    def grown(a: Column, b: Column) -> Column:
        return F.struct(a["page_index"].alias("page_index"), a["col"].alias("col"), a["ann_pos"].alias("ann_pos"), F.least(a["x0"], b["x0"]).alias("x0"), F.least(a["y0"], b["y0"]).alias("y0"), F.greatest(a["x1"], b["x1"]).alias("x1"), F.greatest(a["y1"], b["y1"]).alias("y1"))

    def step(a: Column, x: Column) -> Column:
        joins = meets(a["now"], x)
        return F.struct(F.when(joins, grown(a["now"], x)).otherwise(x).alias("now"), F.when(joins, a["done"]).otherwise(F.array_append(a["done"], a["now"])).alias("done"))

    kind = "array<struct<page_index:bigint,col:bigint,ann_pos:bigint,x0:double,y0:double,x1:double,y1:double>>"
    start = F.struct(F.get("l", F.lit(0)).alias("now"), F.array().cast(kind).alias("done"))
    fold = F.aggregate(F.slice("l", F.lit(2), F.size("l")), start, step, lambda a: F.array_append(a["done"], a["now"]))
    rows = grouped.select("doc_id", "category", "idx", F.posexplode(fold).alias("fragment", "v"))
    return rows.select("doc_id", "category", "idx", F.col("fragment").cast("long").alias("fragment"), "v.page_index", "v.x0", "v.y0", "v.x1", "v.y1", F.when(F.col("fragment") > 0, F.col("fragment").cast("long") - 1).alias("parent_fragment"))


def columns_of(boxes: DataFrame, separations: DataFrame) -> DataFrame:
    """boxes with col: the column whose bounds hold x0; one-column categories have 0. separations: doc_id, page_index, separations array."""
    joined = boxes.join(separations, ["doc_id", "page_index"])
    inside = F.size(F.filter("separations", lambda s: s <= F.col("x0")))
    column = F.when(F.col("category").isin(ONE_COLUMN), 0).otherwise(F.greatest(F.least(inside - 1, F.size("separations") - 2), F.lit(0)))
    return joined.select(*boxes.columns, column.cast("long").alias("col"))


def log_lengths(logs: DataFrame, tag: str = LOG_TAG) -> DataFrame:
    """doc_id, key, value (in points): the last of each length that a TeX log reports. logs: doc_id, log."""
    pattern = rf"(?d)\[{tag}: The (.*) is: ([-+]?\d+\.\d+)pt\]"
    pairs = F.arrays_zip(F.regexp_extract_all("log", F.lit(pattern), F.lit(1)).alias("key"), F.regexp_extract_all("log", F.lit(pattern), F.lit(2)).alias("value"))
    rows = logs.select("doc_id", F.posexplode(pairs).alias("pos", "p"))
    return rows.groupBy("doc_id", F.col("p.key").alias("key")).agg(F.max_by(F.col("p.value").cast("double"), "pos").alias("value"))


def layout_metrics(logs: DataFrame, tag: str = LOG_TAG) -> DataFrame:
    """doc_id, the lengths, num_columns, margin_width and margin_height."""
    wide = log_lengths(logs, tag).groupBy("doc_id").pivot("key", LAYOUT_KEYS).agg(F.first("value"))
    columns = F.bround((F.col("textwidth") + F.col("columnsep")) / (F.col("columnwidth") + F.col("columnsep")), 0).cast("long")
    across = POINTS_PER_INCH + F.col("hoffset") + F.col("oddsidemargin")
    down = POINTS_PER_INCH + F.col("voffset") - (F.col("topmargin") - F.col("headheight")) + F.col("headsep") / 2
    return wide.select("*", columns.alias("num_columns"), across.alias("margin_width"), down.alias("margin_height"))


def separations(metrics: DataFrame, pages: DataFrame) -> DataFrame:
    """doc_id, page_index, px2img, separations: column bounds in image pixels. pages: doc_id, page_index, pdf_width, pdf_height, image_height."""
    scale = F.col("image_height") / F.col("pdf_height")
    step = F.col("columnwidth") + F.col("columnsep")
    inner = F.when(F.col("num_columns") > 1, F.transform(F.sequence(F.lit(1), F.greatest(F.col("num_columns").cast("int") - 1, F.lit(1))), lambda k: (F.col("margin_width") - 0.5 * F.col("columnsep") + k * step) * (PPI / POINTS_PER_INCH) * scale)).otherwise(F.array().cast("array<double>"))
    joined = pages.join(metrics, "doc_id")
    return joined.select("doc_id", "page_index", scale.alias("px2img"), F.concat(F.array(F.lit(0.0)), inner, F.array(F.col("pdf_width") * scale)).alias("separations"))


def to_image(boxes: DataFrame, pages: DataFrame) -> DataFrame:
    """PDF boxes in image pixels. pages: doc_id, page_index, px2img."""
    scaled = {c: (F.col(c) * F.col("px2img")).alias(c) for c in ("x0", "y0", "x1", "y1")}
    return boxes.join(pages.select("doc_id", "page_index", "px2img"), ["doc_id", "page_index"]).select(*(scaled.get(c, F.col(c)) for c in boxes.columns))


def figure_boxes(elements: DataFrame) -> DataFrame:
    """Boxes of a PDF's figures with the origin at the top. elements: doc_id, page_index, kind, x0, y0, x1, y1, page_height."""
    up = lambda c: F.col("page_height") - F.col(c)
    return elements.where("kind = 'LTFigure'").select("doc_id", "page_index", F.lit("Figure").alias("category"), "x0", up("y1").alias("y0"), "x1", up("y0").alias("y1"))


def source_lines(boxes: DataFrame, docs: DataFrame) -> DataFrame:
    """boxes with source_code, the line of the document that line_no (from 1) names."""
    line = F.get(F.split(F.col("tex"), "\n", -1), F.col("line_no").cast("int") - 1)
    return boxes.join(docs.select("doc_id", "tex"), "doc_id").select(*boxes.columns, line.alias("source_code"))


def page_pairs(drawn: DataFrame, blank: DataFrame) -> DataFrame:
    """Pages of two renderings side by side by doc_id and page_index; `missing` marks those that one of them lacks."""
    a, b = (x.select("doc_id", "page_index", F.col("content").alias(n)) for x, n in ((drawn, "drawn"), (blank, "blank")))
    return a.join(b, ["doc_id", "page_index"], "full").withColumn("missing", F.col("drawn").isNull() | F.col("blank").isNull())


def numbered(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """blocks with block_id, deterministic: from 0 for each document in the order of keys."""
    return blocks.withColumn("block_id", (F.row_number().over(Window.partitionBy("doc_id").orderBy(*keys)) - 1).cast("long"))


def mention_blocks(regions: DataFrame, mentions: DataFrame, bounds: DataFrame) -> DataFrame:
    """doc_id, seq, fragment, parent_fragment, category, page_index, box, source_code: the boxes of each mention's changed regions.

    regions: doc_id, category, idx (the mention that a variant leaves out), page_index and a box for each changed region of a page;
    mentions: doc_id, category, idx, seq (its place among all), source_code; bounds: doc_id, page_index, separations. A mention has a
    box for each page and column, those that overlap in sequence are one, and each continues the one before. Regions of no mention, and
    mentions without a region, have no block.
    """
    keys = ["doc_id", "category", "idx"]
    known = mentions.select(*keys, "seq", "source_code")
    placed = columns_of(regions.join(known.select(*keys), keys, "left_semi"), bounds)
    boxes = enclosing(placed, [*keys, "page_index", "col"]).withColumn("ann_pos", F.col("col"))
    return merged_fragments(boxes).join(known, keys).select("doc_id", "seq", "fragment", "parent_fragment", "category", "page_index", "x0", "y0", "x1", "y1", "source_code")


def annotated_blocks(regions: DataFrame, mentions: DataFrame, metrics: DataFrame, pages: DataFrame, elements: DataFrame, figures: DataFrame | None = None) -> DataFrame:
    """The layout annotation of documents, rows of schema.BLOCKS: mentions' blocks in the order of mention, then figures by page and place.

    metrics: rows of layout_metrics; pages: doc_id, page_index, pdf_width, pdf_height, image_height; elements: those of the PDF's pages;
    figures: doc_id, page_index, box, source_code of figures whose source is known, by default none.
    """
    bounds = separations(metrics, pages)
    others = mention_blocks(regions, mentions, bounds.select("doc_id", "page_index", "separations")).withColumn("kind", F.lit(0))
    drawn = to_image(figure_boxes(elements), bounds)
    if figures is not None:
        box = ["doc_id", "page_index", "x0", "y0", "x1", "y1"]
        drawn = drawn.join(figures.groupBy(*box).agg(F.min("source_code").alias("source_code")), box, "left")
    every = others.unionByName(drawn.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    numbered_ = numbered(every, ["kind", "seq", "fragment", "page_index", "y0", "x0", "y1", "x1"])
    parent = F.when(F.col("parent_fragment").isNotNull(), F.col("block_id") - 1)  # fragments of a mention follow one another
    return numbered_.select("doc_id", "block_id", F.col("block_id").alias("ann_pos"), "category", "page_index", "x0", "y0", "x1", "y1", parent.alias("parent_block"), "source_code")
