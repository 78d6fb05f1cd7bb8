"""Continuous ingestion: new LaTeX files are cleaned, have their mentions extracted and are added once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import tex as T
from ..operators.export import export
from ..operators.extract import mentions


#: Folders of the target by document: a batch reads the keys of those that it adds to.
BUCKETS = 256


def document_stream(spark: SparkSession, path: str) -> DataFrame:
    """path, tex of files as they arrive."""
    found = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("pathGlobFilter", "*.tex").option("recursiveFileLookup", "true").load(path)
    return found.select("path", "modificationTime", F.decode("content", "UTF-8").alias("tex"))


def cleaned(stream: DataFrame) -> DataFrame:
    """doc_id (a hash of the path), tex; a path counts once within a day."""
    once = stream.withWatermark("modificationTime", "1 day").dropDuplicatesWithinWatermark(["path"])
    tex = T.without_spare_blank_lines(T.without_line_comments(T.without_comment_envs(T.without_contents_lists(F.col("tex")))))
    return once.select(F.xxhash64("path").alias("doc_id"), tex.alias("tex"))


def ingest(spark: SparkSession, path: str, target: str, checkpoint: str) -> StreamingQuery:
    """Writes the mentions of new files to a dataset in folders by bucket; a batch that runs again adds nothing."""

    def add(batch: DataFrame, _: int) -> None:
        export(mentions(batch).withColumn("bucket", F.pmod("doc_id", F.lit(BUCKETS)).cast("int")), target, ["bucket", "doc_id"])

    return cleaned(document_stream(spark, path)).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
