"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.session import checkpoint_dir, ship_package


def replace_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with ``name`` set to ``value``; a column of that name that is
    already there is replaced."""
    return df.drop(name).withColumn(name, value)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back, so a
    lost executor never recomputes what came before."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def in_workers(df: DataFrame) -> DataFrame:
    """``df``, once its session's Python workers can import this package."""
    ship_package(df.sparkSession)
    return df


def hex16(col: Column) -> Column:
    """A 64-bit value as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(col)), 16, "0")
