"""Stored feature statistics: a JSON object feature -> {p1, p99, mean, null_pct}."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.schemas import BASELINE_STATS


def baseline_from_json(documents: DataFrame, column: str = "value") -> DataFrame:
    """One row per feature: FEATURE, BASE_P1, BASE_P99, BASE_MEAN, BASE_NULL_PCT."""
    parsed = documents.select(F.from_json(column, T.MapType(T.StringType(), BASELINE_STATS)).alias("doc"))
    return parsed.select(F.explode("doc").alias("FEATURE", "s")).select(
        "FEATURE",
        F.col("s.p1").alias("BASE_P1"),
        F.col("s.p99").alias("BASE_P99"),
        F.col("s.mean").alias("BASE_MEAN"),
        F.col("s.null_pct").alias("BASE_NULL_PCT"),
    )


def read_baseline(spark: SparkSession, path: str) -> DataFrame:
    return baseline_from_json(spark.read.text(path, wholetext=True))


def baseline_document(stats: DataFrame) -> DataFrame:
    """feature_stats rows as one JSON document, the form read_baseline takes. One entry per feature column."""
    entry = F.struct(
        F.col("P1").alias("p1"), F.col("P99").alias("p99"),
        F.col("MEAN").alias("mean"), F.col("NULL_PCT").alias("null_pct"))
    return stats.agg(F.map_from_entries(F.collect_list(F.struct("FEATURE", entry))).alias("doc")).select(
        F.to_json("doc").alias("value"))


def flex_overrides(spark: SparkSession, text: str) -> DataFrame:
    """FEATURE, FLEX_PCT from {"feature": {"flex_pct": x}} (or "flex"); invalid JSON means no overrides."""
    try:
        doc = json.loads(text) if text else {}
    except ValueError:
        doc = {}
    rows = [(name, float(v.get("flex_pct", v.get("flex")))) for name, v in doc.items()
            if v.get("flex_pct", v.get("flex")) is not None]
    return spark.createDataFrame(rows, "FEATURE string, FLEX_PCT double")
