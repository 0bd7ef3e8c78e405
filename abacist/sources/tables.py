"""Parquet tables as input of row-wise work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_spread(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table with work for every core.

    Text functions cost far more than reading, so a file that comes as fewer
    splits than there are cores (a row group cannot be split) is dealt out
    first. Anything larger is read as it lies, without a shuffle.
    """
    rows = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows
