"""Datasets for other tools: COCO documents, reading annotations, JSON views, idempotent exports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType

from ..schema import BOX_COLOURS, CATEGORIES
from ..sources.folders import committed, register
from ..sources.rounds import cut
from .quality import category_quality, page_quality, report_header
from .records import successful


def _category_id() -> Column:
    pairs = [F.lit(x) for i, n, _ in CATEGORIES for x in (n, i)]
    return F.element_at(F.create_map(*pairs), F.col("category"))


def coco_annotations(blocks: DataFrame) -> DataFrame:
    """One annotation for each block: id within its page, box as x, y, width, height."""
    w = Window.partitionBy("doc_id", "page_index").orderBy("ann_pos", "block_id")
    wide, high = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    return blocks.select("doc_id", F.col("page_index").alias("image_id"), (F.row_number().over(w) - 1).cast("long").alias("id"), _category_id().cast("long").alias("category_id"), F.col("x0").alias("x"), F.col("y0").alias("y"), wide.alias("width"), high.alias("height"), (wide * high).alias("area"), F.lit(0).cast("long").alias("iscrowd"))


def coco_images(blocks: DataFrame, width: int, height: int) -> DataFrame:
    pages = blocks.select("doc_id", "page_index").distinct()
    return pages.select("doc_id", F.col("page_index").alias("id"), F.lit(width).cast("long").alias("width"), F.lit(height).cast("long").alias("height"), F.format_string("page_%04d.jpg", "page_index").alias("file_name"))


def coco_categories(spark) -> DataFrame:
    return spark.createDataFrame(CATEGORIES, "id long, name string, supercategory string")


def coco_documents(blocks: DataFrame, width: int, height: int) -> DataFrame:
    """doc_id, coco: the whole document as JSON. A document's blocks are bounded by its pages."""
    a = coco_annotations(blocks)
    annotation = F.struct("id", "image_id", "category_id", F.array("x", "y", "width", "height").alias("bbox"), "area", "iscrowd", F.array().cast("array<double>").alias("segmentation"))
    anns = a.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(F.col("image_id").alias("k"), F.col("id").alias("j"), annotation.alias("v")))).alias("a"))
    images = coco_images(blocks, width, height).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("id", "width", "height", "file_name"))).alias("images"))
    kinds = F.array(*(F.struct(F.lit(i).alias("id"), F.lit(n).alias("name"), F.lit(s).alias("supercategory")) for i, n, s in CATEGORIES))
    return images.join(anns, "doc_id").select("doc_id", F.to_json(F.struct("images", F.transform("a", lambda x: x["v"]).alias("annotations"), kinds.alias("categories"))).alias("coco"))


def reading_annotations(blocks: DataFrame) -> DataFrame:
    return blocks.select("doc_id", "block_id", F.array("x0", "y0", "x1", "y1").alias("bbox"), "category", "page_index", "source_code")


def layout_info(blocks: DataFrame) -> DataFrame:
    """doc_id, layout: page -> its blocks in order, as JSON; unset relations are -1 there."""
    block = F.struct("block_id", "category", "page_index", F.coalesce("parent_block", F.lit(-1)).alias("parent_block"), "source_code", F.array("x0", "y0", "x1", "y1").alias("bbox"))
    pages = blocks.groupBy("doc_id", "page_index").agg(F.array_sort(F.collect_list(F.struct("ann_pos", block.alias("b")))).alias("l"))
    entry = F.struct(F.col("page_index").cast("string"), F.transform("l", lambda x: x["b"]))
    return pages.groupBy("doc_id").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("layout"))


def order_annotations(orders: DataFrame) -> DataFrame:
    """doc_id, orders: relations as JSON triples."""
    triple = F.struct("type", F.col("from_id").alias("from"), F.col("to_id").alias("to"))
    return orders.groupBy("doc_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct(F.col("from_id").alias("k"), triple.alias("v")))).getField("v")).alias("orders"))


def blocks_of(layouts: DataFrame) -> DataFrame:
    """Rows of schema.BLOCKS of layout_info's documents (doc_id, layout); ann_pos is a block's place in its document's pages."""
    block = "struct<block_id:bigint,category:string,page_index:bigint,parent_block:bigint,source_code:string,bbox:array<double>>"
    pages = layouts.select("doc_id", F.explode(F.from_json("layout", f"map<string,array<{block}>>")).alias("page", "l"))
    rows = pages.select("doc_id", F.col("page").cast("long").alias("page"), F.posexplode("l").alias("k", "b"))
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("page", "k")) - 1
    corners = [F.get("b.bbox", F.lit(i)).alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))]
    return rows.select("doc_id", "b.block_id", place.cast("long").alias("ann_pos"), "b.category", "b.page_index", *corners, F.when(F.col("b.parent_block") >= 0, F.col("b.parent_block")).alias("parent_block"), "b.source_code")


def relations(blocks: DataFrame, orders: DataFrame) -> DataFrame:
    """doc_id, relations: blocks and their orders as one JSON document."""
    block = F.struct("block_id", "category", "page_index", F.array("x0", "y0", "x1", "y1").alias("bbox"), "source_code", F.coalesce("parent_block", F.lit(-1)).alias("parent_block"))
    a = blocks.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("ann_pos", "block_id", block.alias("v")))).alias("a"))
    triple = F.struct("type", F.col("from_id").alias("from"), F.col("to_id").alias("to"))
    o = orders.groupBy("doc_id").agg(F.array_sort(F.collect_list(triple)).alias("o"))
    none = F.array().cast(o.schema["o"].dataType)
    return a.join(o, "doc_id", "left").select("doc_id", F.to_json(F.struct(F.transform("a", lambda x: x["v"]).alias("annotations"), F.coalesce("o", none).alias("orders"))).alias("relations"))


def reading_annotations_of(documents: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """doc_id, reading, error: the reading annotation of each of relations' documents as JSON.

    A null document, or one without annotations, has an error instead. known: doc_id of those that have one, which are left out.
    """
    block = "struct<block_id:bigint,bbox:array<double>,category:string,page_index:bigint,source_code:string>"
    todo = documents if known is None else documents.join(known.select("doc_id").distinct(), "doc_id", "left_anti")
    found = todo.select("doc_id", "relations", F.from_json("relations", f"struct<annotations:array<{block}>>").alias("p"))
    error = F.when(F.col("relations").isNull(), "no document").when(F.col("p.annotations").isNull(), "no annotations")
    return found.select("doc_id", F.when(error.isNull(), F.to_json("p.annotations")).alias("reading"), error.alias("error"))


def quality_reports(blocks: DataFrame, mentions: DataFrame, metrics: DataFrame) -> DataFrame:
    """doc_id, report: number of pages and columns, quality of categories and pages, as JSON. metrics: doc_id, num_columns."""
    row = lambda df, *columns: df.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("l"))
    categories = row(category_quality(blocks, mentions), "category", "geometry_count", "reading_count", "missing_rate").withColumnRenamed("l", "category_quality")
    pages = row(page_quality(blocks), F.coalesce(F.expr("try_cast(page as int)"), F.lit(-1)).alias("k"), "page", "num_blocks", "area", "overlap", "ratio").select("doc_id", F.transform("l", lambda x: x.dropFields("k")).alias("page_quality"))
    joined = report_header(blocks).join(metrics.select("doc_id", "num_columns"), "doc_id", "left").join(categories, "doc_id", "left").join(pages, "doc_id", "left")
    return joined.select("doc_id", F.to_json(F.struct("num_pages", "num_columns", "category_quality", "page_quality")).alias("report"))


def page_names(pages: DataFrame) -> DataFrame:
    """pages with file_name, the name of an exported page image."""
    return pages.withColumn("file_name", F.format_string("original-page-%04d.jpg", "page_index"))


#: File of a paper's folder -> the column that it holds.
PAPER_FILES = {"quality_report.json": "report", "layout_info.json": "layout", "order_annotation.json": "relations", "reading_annotation.json": "reading", "layout_annotation.json": "coco", "texts.json": "texts"}


def paper_files(papers: DataFrame, documents: dict[str, DataFrame], images: DataFrame | None = None) -> DataFrame:
    """path, content of the files of each paper's folder, discipline/paper_id/name.

    papers: doc_id, discipline, paper_id of those to export; documents: column of PAPER_FILES -> doc_id and that column;
    images: doc_id, page_index, content.
    """
    folder = F.concat_ws("/", "discipline", "paper_id")
    parts = []
    for name, column in PAPER_FILES.items():
        if column in documents:
            text = F.to_json(column) if not isinstance(documents[column].schema[column].dataType, StringType) else F.col(column)
            parts.append(papers.join(documents[column].where(F.col(column).isNotNull()), "doc_id").select(F.concat_ws("/", folder, F.lit(name)).alias("path"), text.cast("binary").alias("content")))
    if images is not None:
        parts.append(papers.join(page_names(images), "doc_id").select(F.concat_ws("/", folder, "file_name").alias("path"), "content"))
    return reduce(DataFrame.unionByName, parts)


def export_papers(statuses: DataFrame, ids: DataFrame, documents: dict[str, DataFrame], folder: str, images: DataFrame | None = None) -> int:
    """Writes the files of each successful paper to folder/discipline/paper_id, and returns how many papers are new in it.

    statuses: path (.../discipline/paper_id), status; ids: path, doc_id; documents, images: as paper_files takes them. Papers that an
    earlier run has committed stay as they are; those of a run that failed are written again. Runs jobs.
    """
    spark = statuses.sparkSession
    register(spark)
    parts = F.split(F.regexp_replace("path", "/+$", ""), "/")
    papers = successful(statuses).distinct().join(ids.select("path", "doc_id"), "path").select("doc_id", F.element_at(parts, -2).alias("discipline"), F.element_at(parts, -1).alias("paper_id"))
    done = committed(spark, folder).select(F.regexp_replace("path", "/[^/]*$", "").alias("_folder")).distinct()
    new = cut(papers.join(done, F.concat_ws("/", "discipline", "paper_id") == F.col("_folder"), "left_anti"), "papers")
    paper_files(new, documents, images).write.format("paper_folder").mode("append").save(folder)
    return new.count()


def json_documents(df: DataFrame, path: str, keys: list[str]) -> None:
    """Appends the rows whose keys the JSON dataset at path has not, in folders by all of keys."""
    _append(df, path, keys, "json")


def overlay(blocks: DataFrame) -> DataFrame:
    """Drawing commands of a page's boxes: file_name, box, label and colour, in the order in which they are drawn."""
    colours = F.array(*map(F.lit, BOX_COLOURS))
    return blocks.select("doc_id", F.format_string("page_%04d.jpg", "page_index").alias("file_name"), F.col("ann_pos").alias("z"), "x0", "y0", "x1", "y1", F.col("category").alias("label"), F.get(colours, _category_id()).alias("colour"))


def export(df: DataFrame, path: str, keys: list[str]) -> None:
    """Appends the rows whose keys the dataset at path has not; running it again adds nothing."""
    _append(df, path, keys, "parquet")


def _append(df: DataFrame, path: str, keys: list[str], form: str) -> None:
    spark = df.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    folders = keys if form == "json" else keys[:1]
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        there = spark.read.schema(df.schema).format(form).load(path)
        # only the keys of the folders that df writes to are read
        there = there.join(df.select(folders[0]).distinct(), folders[0], "left_semi")
        df = df.join(there.select(*keys).distinct(), keys, "left_anti")
    df.write.mode("append").partitionBy(*folders).format(form).save(path)
