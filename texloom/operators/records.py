"""Manifests, metadata upserts, file sets and path rules: keyed set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.tex import normalised_id
from ..schema import SEARCH_RESULTS


def successful(manifest: DataFrame) -> DataFrame:
    """Paths of the documents that were processed. manifest: path, status."""
    return manifest.where("status = 'success'").select("path")


def unprocessed(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return work.join(done.select(key), key, "left_anti")


def upserted(known: DataFrame, new: DataFrame, key: str = "paper_id") -> DataFrame:
    """known, and the rows of new whose key it has not."""
    return known.unionByName(new.join(known.select(key), key, "left_anti").select(*known.columns))


def paper_records(entries: DataFrame, paths: DataFrame | None = None, within: Sequence[str] = ()) -> DataFrame:
    """The metadata rows (schema.PAPERS) of search results (schema.SEARCH_RESULTS); of those of equal id the latest version.

    paths: paper_id, paper_path of the papers that lie here; without it, or for other papers, paper_path is null.
    within: columns of both tables, such as a collection, in which an id stands for one paper; they come first in the result.
    """
    keys = [*within, "paper_id"]
    version = F.coalesce(F.regexp_extract("entry_id", r"v(\d+)$", 1).try_cast("int"), F.lit(0))
    columns = [c.split()[0] for c in SEARCH_RESULTS.split(", ")]
    row = F.struct(*columns)
    latest = entries.groupBy(*within, normalised_id(F.col("entry_id")).alias("paper_id")).agg(F.max_by(row, F.struct(version, F.coalesce("updated", F.lit("")), "entry_id", F.coalesce("title", F.lit("")), F.coalesce("primary_category", F.lit("")))).alias("r"))
    found = latest.select(*within, *(f"r.{c}" for c in columns), "paper_id")
    if paths is None:
        found = found.withColumn("paper_path", F.lit(None).cast("string"))
    else:
        found = found.join(paths.groupBy(*keys).agg(F.min("paper_path").alias("paper_path")), keys, "left")
    return found.select(*within, *columns, "paper_id", "paper_path", F.lit("low").alias("quality"))


def batches(ids: DataFrame, size: int = 100) -> DataFrame:
    """id, batch: ids in requests of `size`."""
    # numbered within a hash shard, so that no one task holds all ids
    shard = F.pmod(F.xxhash64("id"), F.lit(64))
    w = Window.partitionBy("shard").orderBy("id")
    return ids.distinct().withColumn("shard", shard).select("id", F.concat_ws("-", "shard", F.floor((F.row_number().over(w) - 1) / size)).alias("batch"))


def statuses(work: DataFrame, done: DataFrame, failed: DataFrame, key: str = "path") -> DataFrame:
    """key, status, error of each unit of work: success, failed (with the first of its errors by name), or open. done: key; failed: key, error."""
    errors = failed.groupBy(key).agg(F.min("error").alias("error"))
    joined = work.select(key).distinct().join(done.select(key, F.lit(True).alias("_done")).distinct(), key, "left").join(errors, key, "left")
    status = F.when(F.col("error").isNotNull(), "failed").when(F.col("_done"), "success").otherwise("open")
    return joined.select(key, status.alias("status"), "error")


def first_distinct(ids: DataFrame, n: int) -> DataFrame:
    return ids.distinct().orderBy("id").limit(n)


def needed(project: DataFrame, dependencies: DataFrame) -> DataFrame:
    """Files of a project that its compilation reads; both doc_id, path."""
    return project.select("doc_id", "path").intersect(dependencies.select("doc_id", "path"))


def overlaid(original: DataFrame, expanded: DataFrame) -> DataFrame:
    """Project files in which expanded content wins; both doc_id, path, content."""
    other = expanded.select("doc_id", "path", F.col("content").alias("_new"))
    return original.join(other, ["doc_id", "path"], "left").select("doc_id", "path", F.coalesce("_new", "content").alias("content"))


def recorded_inputs(fls: DataFrame) -> DataFrame:
    """doc_id, path: INPUT lines of a compiler's file record, each once. fls: doc_id, line."""
    return fls.select("doc_id", F.regexp_extract("line", r"\AINPUT\s+(.+)\z", 1).alias("path")).where("path <> ''").distinct()


def missing_files(wanted: DataFrame, files: DataFrame) -> DataFrame:
    return wanted.join(files, ["doc_id", "path"], "left_anti")


def main_documents(files: DataFrame, root_depth: int, generated: tuple[str, ...] = ("paper_original.tex", "paper_colored.tex", "paper_white.tex")) -> DataFrame:
    """Main LaTeX files of discipline/paper/file below a root of root_depth parts. files: path, content binary."""
    parts = F.split(F.col("path"), "/")
    name: Column = F.element_at(parts, -1)
    text = F.try_validate_utf8(F.col("content").cast("string"))
    ok = F.endswith(F.col("path"), F.lit(".tex")) & ~F.contains(F.col("path"), F.lit("paper_block_")) & ~name.isin(*generated) & (F.size(parts) == root_depth + 3)
    kept = files.where(ok).withColumn("tex", text).where(F.contains(F.col("tex"), F.lit(r"\begin{document}")))
    return kept.select("path", F.element_at(parts, -3).alias("discipline"), F.element_at(parts, -2).alias("paper_id"), "tex")


def resolved_graphics(docs: DataFrame, files: DataFrame) -> DataFrame:
    """doc_id, old, new: graphics whose name has no known extension, or names a vector format, and what they become.

    docs: doc_id, old (the name in the source); files: doc_id, path. Extensions are tried in a fixed order.
    """
    extensions = [".eps", ".ps", ".jpg", ".jpeg", ".png", ".pdf"]
    known = F.exists(F.array(*map(F.lit, extensions)), lambda x: F.contains(F.col("old"), x))
    rank = F.array(*(F.struct(F.lit(i).alias("rank"), F.lit(e).alias("ext")) for i, e in enumerate(extensions)))
    tried = docs.select("doc_id", "old", F.explode(F.when(known, F.array(F.struct(F.lit(0).alias("rank"), F.lit("").alias("ext")))).otherwise(rank)).alias("e"))
    tried = tried.select("doc_id", "old", "e.rank", F.concat("old", "e.ext").alias("path"))
    found = tried.join(files.select("doc_id", "path").distinct(), ["doc_id", "path"]).groupBy("doc_id", "old").agg(F.min_by("path", "rank").alias("path"))
    kept = F.col("path").rlike(r"\.(jpg|jpeg|png)$")
    return found.select("doc_id", "old", F.when(kept, F.col("path")).otherwise(F.regexp_replace("path", r"\.[^./]*$", ".png")).alias("new"))


def with_replacements(docs: DataFrame, replacements: DataFrame) -> DataFrame:
    """docs (doc_id, tex) with each old graphics name in braces by its new one."""
    by = replacements.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("old", "new"))).alias("_r"))
    new = F.aggregate(F.coalesce("_r", F.array().cast("array<struct<old:string,new:string>>")), F.col("tex"), lambda t, r: F.replace(t, F.concat(F.lit("{"), r["old"], F.lit("}")), F.concat(F.lit("{"), r["new"], F.lit("}"))))
    return docs.join(by, "doc_id", "left").select("doc_id", new.alias("tex"))
