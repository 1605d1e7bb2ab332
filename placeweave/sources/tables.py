"""Parquet tables of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Over all cores, if the files are too few for that.

    A file of one row group is read by one task, which starves work that is heavy per row.
    Inputs of many files come with enough partitions and are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def evened(df: DataFrame) -> DataFrame:
    """A table just written, dealt out anew if it is so small that its files are read several to a task.

    Whatever has more tasks than there are cores is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    n = df.rdd.getNumPartitions()
    return df if n > cores or len(df.inputFiles()) <= n == cores else df.repartition(cores)
