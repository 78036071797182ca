"""Robust scaling per segment: centre = median, scale = interquartile range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.functions.vectors import complete_vector, scaled
from tierloom.operators.quantiles import exact_quantiles, long_features
from tierloom.sources.staging import with_size_check


def robust_scaler_rows(train: DataFrame, features: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """SEGMENT_KEY, FEATURE, CENTER, SCALE; a constant feature gets scale 1."""
    q = exact_quantiles(
        long_features(train, ["SEGMENT_KEY"], features), ["SEGMENT_KEY", "FEATURE"], [0.25, 0.5, 0.75],
        accuracy=accuracy)
    iqr = F.col("Q")[2] - F.col("Q")[0]
    return q.select(
        "SEGMENT_KEY", "FEATURE", F.col("Q")[1].alias("CENTER"), F.when(iqr == 0, 1.0).otherwise(iqr).alias("SCALE"))


def robust_scaler(train: DataFrame, features: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """One row per segment with CENTER and SCALE arrays in feature order."""
    by_feature = F.map_from_entries(F.collect_list(F.struct("FEATURE", F.struct("CENTER", "SCALE"))))
    names = F.array(*[F.lit(f) for f in features])
    return (
        robust_scaler_rows(train, features, accuracy)
        .groupBy("SEGMENT_KEY").agg(by_feature.alias("__m"))
        .select(
            "SEGMENT_KEY",
            F.transform(names, lambda f: F.element_at("__m", f)["CENTER"]).alias("CENTER"),
            F.transform(names, lambda f: F.element_at("__m", f)["SCALE"]).alias("SCALE"))
    )


def scaled_rows(train: DataFrame, scaler: DataFrame, features: Sequence[str]) -> DataFrame:
    """train with Z, the scaled feature vector. Pass a staged scaler, so that its size is known."""
    return (
        train.withColumn("Z", F.expr(complete_vector(features)))
        .join(with_size_check(scaler), "SEGMENT_KEY")
        .withColumn("Z", F.expr(scaled("Z", "CENTER", "SCALE")))
        .drop("CENTER", "SCALE")
    )
