"""Tables in folders, and windows over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.window import Window, WindowSpec


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def window(keys: list[str], order: list[Column]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def spread(df: DataFrame) -> DataFrame:
    """Repartition only where a scan has fewer than half as many partitions as there are cores.

    One small file is one partition and would keep one core busy with costly text rules. A scan that
    fills the cluster is left alone, so nothing is shuffled at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 <= cores else df
