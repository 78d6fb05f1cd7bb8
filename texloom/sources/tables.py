"""Parquet tables, read so that small ones use all cores too."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread(df: DataFrame) -> DataFrame:
    """df dealt out over all cores if its files have fewer splits than that; large tables are left as they lie."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{folder}/{name}.parquet"))
