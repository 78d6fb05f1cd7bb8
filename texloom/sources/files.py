"""Files as tables. Schemas are explicit; nothing is inferred."""

from __future__ import annotations

import tarfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F


# Extensions of the files that a LaTeX project is made of.
SOURCES = ".tex .cls .clo .sty .bst".split()


def files(spark: SparkSession, path: str, extension: str | list[str] | None = None) -> DataFrame:
    """path, content (binary) of every file below path, of one extension or of several."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if extension:
        names = [extension] if isinstance(extension, str) else extension
        reader = reader.option("pathGlobFilter", f"*{{{','.join(names)}}}")
    return reader.load(path).select("path", "content")


def texts(spark: SparkSession, path: str, extension: str = ".tex", encoding: str = "UTF-8") -> DataFrame:
    """path, text: a file each."""
    return files(spark, path, extension).select("path", F.decode("content", encoding).alias("text"))


def json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """path, status of processed documents."""
    return spark.read.schema("path string, status string").option("header", "true").csv(path)


def papers(found: DataFrame) -> DataFrame:
    """discipline, paper_id of files that lie in discipline/paper_id/file."""
    parts = F.split(F.col("path"), "/")
    return found.select(F.element_at(parts, -3).alias("discipline"), F.element_at(parts, -2).alias("paper_id")).distinct()


# How rendered pages and the folders of variants are named.
PAGE_NAME = r"thread-\d+-page-(\d+)\.jpg$"
VARIANT_NAME = r"paper_(\w+)_(\d{5})_(.*?)_(\d{5})"


def page_images(found: DataFrame) -> DataFrame:
    """path, page_index (from 0), content of rendered pages."""
    page = F.regexp_extract("path", PAGE_NAME, 1)
    return found.where(page != "").select("path", (page.cast("int") - 1).alias("page_index"), "content")


def variant_folders(paths: DataFrame) -> DataFrame:
    """path, seq, category, idx of the folders of one-mention variants."""
    part = lambda k: F.regexp_extract("path", VARIANT_NAME, k)
    return paths.where(F.col("path").rlike(VARIANT_NAME)).select("path", part(2).cast("int").alias("seq"), part(3).alias("category"), part(4).cast("int").alias("idx"))


def archive_members(archives: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """path, member, content, error of the files in .tar.gz archives; what cannot be read of an archive is one row with its error.

    Members are handed on one by one. known: paths of archives that were read before, which are left out.
    """
    schema = pa.schema([("path", pa.string()), ("member", pa.string()), ("content", pa.binary()), ("error", pa.string())])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = lambda *values: pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, schema.types, strict=True)], schema=schema)
        for batch in batches:
            for k in range(batch.num_rows):
                path, content = batch.column(0)[k].as_py(), batch.column(1)[k]
                try:
                    with tarfile.open(fileobj=pa.BufferReader(content.as_buffer() if content.is_valid else b""), mode="r:*") as tar:
                        for m in tar:
                            if m.isfile():
                                yield row(path, m.name, tar.extractfile(m).read(), None)
                except (tarfile.TarError, EOFError, OSError, zlib.error) as e:
                    yield row(path, None, None, str(e)[:300])

    todo = archives if known is None else archives.join(known.select("path").distinct(), "path", "left_anti")
    return todo.select("path", "content").mapInArrow(unpack, "path string, member string, content binary, error string")
