"""Feature statistics of runs that merge: quantile sketches, counts and sums stored with each run.

A run's row per feature holds a KLL sketch of its values; the statistics of any union of runs come from merging those rows,
without reading the data again. A quantile's true rank lies within rank_error(k) of the wanted one, with the confidence
(about 99 %) that the sketch's published error bound states.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.functions.columns import to_number

DEFAULT_K = 2000


def rank_error(k: int = DEFAULT_K) -> float:
    """Normalised rank error of one quantile (the fixed fit that the sketch's authors publish)."""
    return 2.296 / k ** 0.9021


def run_sketches(df: DataFrame, run_col: str, features: Sequence[str], k: int = DEFAULT_K) -> DataFrame:
    """RUN, FEATURE, TOTAL_ROWS, VALUES, TOTAL, SKETCH (null without a value): one scan, one wide aggregate."""
    aggs = []
    for f in features:
        x = to_number(F.col(f"`{f}`"))
        aggs.append(F.struct(
            F.count(x).alias("n"), F.sum(x).alias("total"), F.kll_sketch_agg_double(x, F.lit(k)).alias("sketch")).alias(f"s_{f}"))
    entries = [F.struct(
        F.lit(f).alias("FEATURE"), F.col("n").alias("TOTAL_ROWS"), F.col(f"`s_{f}`")["n"].alias("VALUES"),
        F.col(f"`s_{f}`")["total"].alias("TOTAL"),
        F.when(F.col(f"`s_{f}`")["n"] > 0, F.col(f"`s_{f}`")["sketch"]).alias("SKETCH")) for f in features]
    return df.groupBy(F.col(run_col).alias("RUN")).agg(F.count(F.lit(1)).alias("n"), *aggs).select("RUN", F.inline(F.array(*entries)))


def merged(sketches: DataFrame, by: Sequence[str] = (), k: int = DEFAULT_K) -> DataFrame:
    """The same columns for unions of runs: one row per feature and value of `by`."""
    return sketches.groupBy(*by, "FEATURE").agg(
        F.sum("TOTAL_ROWS").alias("TOTAL_ROWS"), F.sum("VALUES").alias("VALUES"), F.sum("TOTAL").alias("TOTAL"),
        F.when(F.sum("VALUES") > 0, F.kll_merge_agg_double("SKETCH", F.lit(k))).alias("SKETCH"))


def quantiles(sketches: DataFrame, ps: Sequence[float]) -> DataFrame:
    """sketches with Q: the values at the wanted ranks (null without a value)."""
    return sketches.withColumn("Q", F.when(F.col("SKETCH").isNotNull(), F.array(*[
        F.kll_sketch_get_quantile_double("SKETCH", F.lit(float(p))) for p in ps])))


def merged_stats(sketches: DataFrame) -> DataFrame:
    """FEATURE, TOTAL_ROWS, P1, P99, MEAN, NULL_PCT as feature_stats has them, from merged sketches."""
    return quantiles(sketches, [0.01, 0.99]).select(
        "FEATURE", "TOTAL_ROWS", F.col("Q")[0].alias("P1"), F.col("Q")[1].alias("P99"),
        F.try_divide("TOTAL", "VALUES").alias("MEAN"),
        F.try_divide(F.col("TOTAL_ROWS") - F.col("VALUES"), F.col("TOTAL_ROWS")).alias("NULL_PCT"))


def merged_edges(sketches: DataFrame, ps: Sequence[float]) -> DataFrame:
    """FEATURE, BASE_N, EDGES as drift_edges has them, from merged sketches."""
    return quantiles(sketches, ps).where("VALUES > 0").select(
        "FEATURE", F.col("VALUES").alias("BASE_N"), F.array_sort(F.array_distinct("Q")).alias("EDGES"))


def true_ranks(values: DataFrame, found: DataFrame) -> DataFrame:
    """FEATURE, P, LOW, HIGH: share of the values below each quantile, and at most it. values: FEATURE, VALUE; found:
    FEATURE, P, Q with a row per feature and rank (few rows, hence the broadcast)."""
    present = values.where("VALUE is not null")
    return present.join(F.broadcast(found), "FEATURE").groupBy("FEATURE", "P").agg(
        (F.count_if(F.col("VALUE") < F.col("Q")) / F.count(F.lit(1))).alias("LOW"),
        (F.count_if(F.col("VALUE") <= F.col("Q")) / F.count(F.lit(1))).alias("HIGH"))
