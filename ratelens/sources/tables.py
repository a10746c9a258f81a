"""Parquet tables of a data folder (one ``<name>.parquet`` per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Read one table; column pruning and filters reach the parquet scan."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
