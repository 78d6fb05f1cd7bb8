"""Project cleaning: includes in place, comments and spare lines gone, only the files that a compilation reads."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import tex as T
from ..sources import files
from ..sources.folders import register
from ..sources.rounds import cut
from . import closure, includes, records
from .export import export
from .extract import document_statuses, mentions
from .order import reading_order
from .quality import category_quality, page_quality
from .refs import float_and_cross_references

#: Paths of source and style files.
SOURCE_NAME = "(?:" + "|".join(x.replace(".", "[.]") for x in files.SOURCES) + ")$"


def clean_documents(docs: DataFrame) -> DataFrame:
    """doc_id, tex without comment environments, line comments, contents lists, old figure commands and spare blank lines."""
    tex = T.without_line_comments(T.without_comment_envs("tex"))
    return docs.select("doc_id", T.without_spare_blank_lines(T.with_plain_graphics(T.without_contents_lists(tex))).alias("tex"))


def clean_project(found: DataFrame, roots: DataFrame, recorded: DataFrame | None = None) -> DataFrame:
    """doc_id, path, content of the needed files of each project, its roots expanded and cleaned.

    found: doc_id, path, tex of files; roots: doc_id, path; recorded: doc_id, line of the compiler's file record; without it the files that the
    roots name, directly or through others, are needed. Roots and their .bbl files are kept in any case, and no source or style file
    keeps spare blank lines. Runs jobs.
    """
    paths = found.select("doc_id", "path")
    wanted = closure.dependencies(found, roots) if recorded is None else records.needed(paths, records.recorded_inputs(recorded))
    wanted = cut(wanted.union(roots.select("doc_id", "path")).union(roots.select("doc_id", T.with_extension(F.col("path"), ".bbl").alias("path"))).distinct(), "wanted")
    # both tables are written, so that their sizes are known: the texts of files that nobody needs go through no shuffle
    cleaned = cut(includes.resolved(found, roots).select("doc_id", "path", T.without_line_comments(T.without_comment_envs("tex")).alias("content")), "cleaned")
    kept = found.join(wanted, ["doc_id", "path"], "left_semi").select("doc_id", "path", F.col("tex").alias("content"))
    tidy = F.when(F.col("path").rlike(SOURCE_NAME), T.without_spare_blank_lines("content")).otherwise(F.col("content"))
    return records.overlaid(kept, cleaned).select("doc_id", "path", tidy.alias("content"))


def annotated(docs: DataFrame, blocks: DataFrame) -> dict[str, DataFrame]:
    """All tables that one run over documents (doc_id, tex) and their layout blocks gives; each is a plan of its own. The blocks, which most of them read several times, are written first."""
    blocks = cut(blocks, "blocks")
    found = mentions(clean_documents(docs))
    orders = reading_order(blocks).unionByName(float_and_cross_references(blocks, docs))
    return {"mentions": found, "orders": orders, "pages": page_quality(blocks), "categories": category_quality(blocks, found)}


def process_discipline(folder: DataFrame, root_depth: int, target: str, discipline: str | None = None) -> DataFrame:
    """Finds the main documents among the files (path, content) of a root of root_depth parts, cleans them and adds their mentions and statuses to target; returns the statuses.

    Documents whose status target has already are left out, so a run that is repeated, or goes on after a failure, adds each once. A
    document that cannot be cleaned or extracted is a row of status failed. Runs jobs.
    """
    spark = folder.sparkSession
    found = records.main_documents(folder, root_depth)
    found = (found if discipline is None else found.where(F.col("discipline") == discipline)).select(F.xxhash64("path").alias("doc_id"), "path", "discipline", "tex")
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/statuses")
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        found = records.unprocessed(found, spark.read.parquet(f"{target}/statuses"), "doc_id")
    docs = cut(found, "discipline")
    cleaned = clean_documents(docs)
    export(mentions(cleaned).join(docs.select("doc_id", "discipline"), "doc_id"), f"{target}/mentions", ["discipline", "doc_id"])
    said = cut(document_statuses(cleaned).join(docs.select("doc_id", "discipline", "path"), "doc_id").select("discipline", "doc_id", "path", "status", "error"), "statuses")
    export(said, f"{target}/statuses", ["discipline", "doc_id"])
    return said


def clean_folder(spark: SparkSession, source: str, target: str, roots: list[str] | None = None) -> int:
    """Writes a cleaned copy of the project in a folder to another: the files that its roots need, with includes in place and comments gone. Returns how many.

    roots: paths below source of the documents to keep, or else all that hold a document. Files other than sources are copied as they are. Runs jobs.
    """
    register(spark)
    base = F.lit(re.sub(r"^file:/*", "/", source).rstrip("/") + "/")
    path = F.regexp_replace("path", "^file:/*", "/")
    found = files.files(spark, source).select(F.lit(0).cast("bigint").alias("doc_id"), T.relative_path(path, base).alias("path"), "content")
    text = F.when(F.col("path").rlike(SOURCE_NAME), F.try_validate_utf8(F.col("content").cast("string")))
    project = cut(found.withColumn("tex", text), "project")
    main = project.where(F.contains("tex", F.lit(r"\begin{document}")) if roots is None else F.col("path").isin(roots)).select("doc_id", "path")
    kept = clean_project(project.select("doc_id", "path", "tex"), main).withColumnRenamed("content", "_new")
    made = cut(project.join(kept, ["doc_id", "path"]).select("path", F.coalesce(F.col("_new").cast("binary"), "content").alias("content")), "cleaned")
    made.write.format("paper_folder").mode("append").save(target)
    return made.count()
