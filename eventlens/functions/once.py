"""Keeping an expensive expression from being copied around a plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """``withColumn`` for a column that filters above must not work out again.

    Spark moves a filter below the projections it reads from and copies their
    expressions into it. It does not move one below a generator, so a generator of
    exactly one row keeps a parsed value parsed once.
    """
    return df.select("*", F.explode(F.array(column)).alias(name))
