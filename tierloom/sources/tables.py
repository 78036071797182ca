"""Table scans: projection, name normalisation, numeric column inference, extract window, row sample."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.functions.sampling import hash_order, in_fraction


def read_table(spark: SparkSession, source: str) -> DataFrame:
    """A path with a slash is read as Parquet, anything else is a catalog table."""
    return spark.read.parquet(source) if "/" in source else spark.table(source)


def normalized_scan(df: DataFrame | None, spark: SparkSession | None = None) -> DataFrame:
    """All columns with upper-case names; a missing result becomes an empty table."""
    if df is None:
        return spark.createDataFrame([], T.StructType([]))
    return df.toDF(*[c.upper() for c in df.columns])


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ("CLUSTER_LABEL",)) -> list[str]:
    skip = {c.upper() for c in exclude}
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name.upper() not in skip]


def explanation_columns(df: DataFrame) -> list[str]:
    """Feature columns for explanation: every numeric column but the segment and the label."""
    return numeric_columns(df, exclude=("SEGMENT", "CLUSTER_LABEL"))


def extract_window(
    df: DataFrame, key: str, start_date: str = "", end_date: str = "", row_limit: int = 0,
    date_col: str = "ORDER_DATE",
) -> DataFrame:
    """Rows with start <= date < end; the range reaches the Parquet scan. row_limit keeps the first keys."""
    if start_date:
        df = df.where(F.col(date_col) >= F.lit(start_date).cast(df.schema[date_col].dataType))
    if end_date:
        df = df.where(F.col(date_col) < F.lit(end_date).cast(df.schema[date_col].dataType))
    return sample_scan(df, df.columns, key, row_limit) if row_limit > 0 else df


def sample_scan(df: DataFrame, cols: Sequence[str], key: str, limit: int = 0) -> DataFrame:
    """Projected scan of at most `limit` rows: the ones first in a fixed pseudo-random order of `key`.

    A key-hash filter keeps slightly more than `limit` rows before the top-n, so that large tables do not
    sort `limit` rows per partition. If the filter turns out too narrow (few distinct keys), it is not used.
    """
    if limit <= 0:
        return df.select(*cols)
    rows = df.count()
    if rows > limit:
        wanted = limit + 6.0 * math.sqrt(limit) + 10.0
        narrowed = df.where(in_fraction(wanted / rows, key)) if wanted < rows else df
        if wanted < rows and narrowed.limit(limit).count() == limit:
            df = narrowed
    return df.orderBy(hash_order(key), F.col(key)).limit(limit).select(*cols)
