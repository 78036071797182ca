"""Exact top-n rows per group that also holds for groups far larger than one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, salts: int = 64, rank_col: str | None = None,
) -> DataFrame:
    """The first n rows of every group in the given order.

    Ranked twice: first within (group, salt), where a hot group is spread over `salts` tasks, then over the at
    most salts * n survivors of each group.
    """
    salt = F.pmod(F.xxhash64(*order), F.lit(salts))
    keys = [F.col(c) for c in by]
    inner = Window.partitionBy(*keys, "__salt").orderBy(*order)
    outer = Window.partitionBy(*keys).orderBy(*order)
    out = (
        df.withColumn("__salt", salt)
        .withColumn("__rank", F.row_number().over(inner)).where(F.col("__rank") <= n)
        .withColumn("__rank", F.row_number().over(outer)).where(F.col("__rank") <= n)
        .drop("__salt")
    )
    return out.withColumnRenamed("__rank", rank_col) if rank_col else out.drop("__rank")
