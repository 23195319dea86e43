"""Parquet table reader: the scan as Spark splits it, with filters and columns pushed down."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
