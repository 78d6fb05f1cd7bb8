"""Tables and files in the folder that the driver and all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources.rounds import new_folder as new_path, shared_dir

__all__ = ["file_system", "local_uri", "new_path", "shared_dir", "table_bytes", "written"]


#: Writer's options for rows of megabytes: a row group ends at 8 MB. Its size is otherwise looked at after 100 rows only, and readers and writers hold a whole group.
LARGE_ROWS = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}


def written(df: DataFrame, name: str, compact: bool = False, large_rows: bool = False) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage and survives lost executors.

    compact: rows are brought together first, into files of the advisory size, where tasks are many and rows few and small.
    large_rows: a row may hold megabytes.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    (df.hint("rebalance") if compact else df).write.options(**(LARGE_ROWS if large_rows else {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table_bytes(df: DataFrame) -> int:
    """Bytes of the files that df reads, by the file system's own listing."""
    spark = df.sparkSession
    total = 0
    for f in df.inputFiles():
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        total += path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
    return total


def local_uri(path: str) -> str:
    """A URI for pyarrow.fs: plain paths become file:// ones."""
    if path.startswith("file:"):
        return "file://" + "/" + path[len("file:"):].lstrip("/")
    return path if "://" in path else "file://" + path


def file_system(uri: str):
    """(pyarrow file system, path in it) of a URI; works in executors, without a JVM."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(local_uri(uri))
