"""Model choice per segment, the model table, and the acceptance gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierloom.schemas import SEGMENT_MODEL


def best_k(scores: DataFrame) -> DataFrame:
    """SEGMENT_KEY, BEST_K, BEST_SILHOUETTE: highest silhouette, the smallest k on a tie."""
    order = Window.partitionBy("SEGMENT_KEY").orderBy(F.desc("SILHOUETTE"), "K")
    return (
        scores.where(F.col("SILHOUETTE").isNotNull())
        .withColumn("__rank", F.row_number().over(order)).where("__rank = 1")
        .select("SEGMENT_KEY", F.col("K").alias("BEST_K"), F.col("SILHOUETTE").alias("BEST_SILHOUETTE"))
    )


def model_table(
    status: DataFrame, scores: DataFrame, models: DataFrame, scaler: DataFrame, features: Sequence[str],
    run_id: str, run_timestamp: str, input_table: str | None = None,
) -> DataFrame:
    """One row per segment in the SEGMENT_MODEL schema; skipped segments have no centroids.

    `status` comes from segment_status, `models` has the CENTERS of every (SEGMENT_KEY, K). The winning
    centres are taken as they are, so no refit follows. All inputs are at segment grain.
    """
    results = scores.groupBy("SEGMENT_KEY").agg(
        F.array_sort(F.collect_list(F.struct(F.col("K").alias("k"), F.col("SILHOUETTE").alias("silhouette"))))
        .alias("results_k"))
    chosen = models.select("SEGMENT_KEY", F.col("K").alias("BEST_K"), F.col("CENTERS").alias("centroids"))
    clustered = F.col("STATUS") == "CLUSTERED"
    table = (
        status.join(results, "SEGMENT_KEY", "left")
        .join(chosen, ["SEGMENT_KEY", "BEST_K"], "left")
        .join(scaler, "SEGMENT_KEY", "left")
        .select(
            F.lit(run_id).alias("run_id"), F.lit(run_timestamp).alias("run_timestamp"),
            F.col("SEGMENT_KEY").alias("segment_key"), F.col("INDUSTRY").alias("industry"),
            F.col("SEGMENT").alias("segment"), F.col("STATUS").alias("status"),
            F.col("CUSTOMER_COUNT").alias("customer_count"), F.col("BEST_K").alias("best_k"),
            F.col("BEST_SILHOUETTE").alias("best_silhouette"), "results_k",
            F.when(clustered, F.array(*[F.lit(f) for f in features])).alias("features"),
            F.when(clustered, F.col("CENTER")).alias("center"),
            F.when(clustered, F.col("SCALE")).alias("scale"),
            F.when(clustered, F.col("centroids")).alias("centroids"),
            F.lit(input_table).cast("string").alias("input_table"),
            *[F.lit(None).alias(c) for c in ("x_cols", "y_col", "output_table")])
    )
    return table.select(*[F.col(f.name).cast(f.dataType) for f in SEGMENT_MODEL])


def model_gate(models: DataFrame, threshold: float = 0.20, min_segments: int = 1) -> DataFrame:
    """One row per run: mean silhouette over its clustered segments, and ok / warn / fail.

    warn reaches down to 0.8 * threshold; fewer than min_segments clustered segments fail.
    """
    scored = F.when(F.col("status") == "CLUSTERED", F.col("best_silhouette"))
    gate = models.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("segments_total"), F.count(scored).alias("clustered_segments"),
        F.avg(scored).alias("avg_silhouette"))
    avg = F.col("avg_silhouette")
    return gate.withColumn(
        "status",
        F.when(F.col("clustered_segments") < max(1, min_segments), "fail")
        .when(avg >= threshold, "ok")
        .when(avg >= threshold * 0.8, "warn")
        .otherwise("fail"))


def accepted_models(
    gate: DataFrame, display_name: str, bundle_root: str, labels_json: str = "{}", description: str = "",
) -> DataFrame:
    """The registry record of every run whose gate is ok."""
    return gate.where(F.col("status") == "ok").select(
        "run_id",
        F.concat(F.lit(f"{display_name}-"), F.col("run_id")).alias("model_name"),
        F.concat(F.lit(f"{bundle_root.rstrip('/')}/run_id="), F.col("run_id")).alias("bundle_uri"),
        F.lit(labels_json).alias("labels_json"),
        F.lit(description).alias("description"),
        "avg_silhouette",
    )
