"""Iterative plans: a table is cut from its lineage after each round."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Used only where spark.checkpoint.dir is unset and all executors are in this process, as in tests.
LOCAL_DIR = "file:///tmp/checkpoints/texloom"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a cluster must name one."""
    found = spark.conf.get("spark.checkpoint.dir", "")
    if not found and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (found or LOCAL_DIR).rstrip("/")


def new_folder(spark: SparkSession, name: str = "round") -> str:
    """A folder in the shared one that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "round") -> DataFrame:
    """df, computed once and written as a table in the shared folder."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
