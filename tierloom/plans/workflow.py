"""The four end-to-end jobs: train and accept, score, watch drift, explain.

Tables stay distributed from stage to stage. Read on the driver are gate statuses, one row each.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import wraps

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.operators import customers as cust
from tierloom.operators import drift, explain, quality, scoring, segments, selection, training
from tierloom.schemas import ORDERS_INPUT
from tierloom.sources import bundle, sinks, tables
from tierloom.sources.baseline import flex_overrides
from tierloom.sources.staging import stage, temporary_tables


def _job(run):
    """Removes the intermediate tables of a job when it ends; jobs return statuses and counts, no tables."""
    @wraps(run)
    def wrapped(*args, **kwargs):
        with temporary_tables(SparkSession.active()):
            return run(*args, **kwargs)
    return wrapped


@dataclass(frozen=True)
class TrainOutcome:
    quality_status: str
    feature_status: str
    model_status: str | None
    accepted: bool


def prepare(
    orders: DataFrame, as_of: str, min_segment_size: int = 60, use_msa: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(order-grain prepared table, customer features) from the extracted orders."""
    profiles = stage(segments.segment_profiles(orders, min_segment_size, use_msa), "segmented")
    return segments.prepare_orders(orders, profiles), cust.customer_features(profiles, as_of)


@_job
def train_validate_accept(
    orders: DataFrame, baseline: DataFrame, out: str, run_id: str, run_timestamp: str, as_of: str,
    opts: training.TrainingOptions = training.TrainingOptions(), min_segment_size: int = 60, min_rows: int = 100,
    start_date: str = "", end_date: str = "", row_limit: int = 0, row_key: str = "CUSTOMER_ID",
    flex_pct: float = 0.5, overrides_json: str = "", silhouette_threshold: float = 0.20, min_segments: int = 1,
    model_name: str = "segment-clusters",
) -> TrainOutcome:
    """Extract, quality check, preprocessing, feature gate, training, model gate, acceptance.

    Writes prepared/, customers/, models/, accepted/ and reports/ below `out`. Training runs only if neither
    the quality check nor the feature gate fails; a model is accepted only if its gate is ok.
    """
    spark = orders.sparkSession
    reports = f"{out}/reports"
    if start_date or end_date or row_limit:
        orders = stage(
            tables.extract_window(orders, row_key, start_date, end_date, row_limit), "extract")

    checks = stage(quality.dq_check(orders, ORDERS_INPUT.fieldNames(), min_rows), "dq")
    sinks.write_report(checks, reports, "data_quality", run_id)
    dq_status = quality.roll_up(checks).first()["STATUS"]
    if dq_status == "fail":
        return TrainOutcome(dq_status, "skipped", None, False)

    prepared, customers = prepare(orders, as_of, min_segment_size)
    sinks.write_run(prepared, f"{out}/prepared", run_id)
    sinks.write_run(customers, f"{out}/customers", run_id)
    customers = spark.read.parquet(f"{out}/customers").where(
        F.col("RUN_ID") == sinks.safe_run_id(run_id)).drop("RUN_ID")

    names = [r["FEATURE"] for r in baseline.select("FEATURE").collect() if r["FEATURE"] in customers.columns]
    stats = (quality.feature_stats(customers, names) if names else
             spark.createDataFrame(
                 [], "FEATURE string, TOTAL_ROWS long, P1 double, P99 double, MEAN double, NULL_PCT double"))
    overrides = flex_overrides(spark, overrides_json) if overrides_json else None
    checked = stage(quality.feature_check(stats, baseline, overrides, flex_pct), "feature-check")
    sinks.write_report(checked, reports, "feature_threshold", run_id)
    feature_status = quality.feature_gate(checked).first()["STATUS"]
    if feature_status == "fail":
        failed = [r["FEATURE"] for r in checked.where("STATUS = 'fail' AND PRESENT").select("FEATURE").collect()]
        if failed:
            sinks.write_report(
                quality.failing_rows(customers, checked, failed, "CUSTOMER_ID"), reports, "failing_rows", run_id)
        return TrainOutcome(dq_status, feature_status, None, False)

    models = training.train(customers, run_id, run_timestamp, opts)
    bundle.write_bundle(models, f"{out}/models")
    models = bundle.resolve_run(bundle.read_bundle(spark, f"{out}/models"), run_id)
    gate = selection.model_gate(models, silhouette_threshold, min_segments)
    sinks.write_report(gate, reports, "model_validation", run_id)
    model_status = gate.first()["status"]
    accepted = model_status == "ok"
    if accepted:
        sinks.append_accepted(
            selection.accepted_models(gate, model_name, f"{out}/models"), f"{out}/accepted")
    return TrainOutcome(dq_status, feature_status, model_status, accepted)


@_job
def batch_score(
    spark: SparkSession, customers: DataFrame, models_path: str, out_path: str, scored_at: str,
    run_id: str = "latest", segment_col: str = "SEGMENT",
) -> int:
    """Scores a customer table with a stored run and replaces the output table (sinks.read_path reads it); returns the
    row count."""
    models = bundle.open_run(spark, models_path, run_id)
    used = models.agg(F.max("run_id").alias("r")).first()["r"]
    scored = scoring.score_segments(customers, models, used, scored_at, segment_col)
    return sinks.overwrite_path(scored, out_path)


@_job
def watch_drift(
    baseline: DataFrame, current: DataFrame, reports: str, run_id: str, features: Sequence[str] = (),
    **thresholds: float,
) -> str:
    """PSI per feature and KL of the cluster shares; writes the reports and returns the overall status.

    Labels that a side lacks are a note. A comparison that cannot be computed ends in a report with status fail.
    """
    spark = baseline.sparkSession
    try:
        features = list(features) or tables.numeric_columns(current)
        psi, kl, status = drift.drift_report(baseline, current, features, **thresholds)
        psi = stage(psi, "psi")
        sinks.write_report(psi, reports, "drift_features", run_id)
        if kl is not None:
            kl = stage(kl, "kl")
            status = drift.drift_status(psi, kl)
        else:
            kl = spark.createDataFrame([("CLUSTER_LABEL not available in both tables", "ok")], "NOTE string, STATUS string")
            status = drift.drift_status(psi)
        sinks.write_report(kl, reports, "drift_clusters", run_id)
        sinks.write_report(status, reports, "drift_status", run_id)
        return status.first()["STATUS"]
    except PySparkException as error:
        sinks.write_report(spark.createDataFrame(
            [("fail", str(error)[:2000])], "STATUS string, ERROR string"), reports, "drift_status", run_id)
        return "fail"


@_job
def watch_drift_by_stats(current: DataFrame, baseline: DataFrame, reports: str, run_id: str) -> str:
    """The fallback without a baseline table: means and null shares against stored statistics."""
    names = [r["FEATURE"] for r in baseline.select("FEATURE").collect() if r["FEATURE"] in current.columns]
    report = stage(drift.drift_vs_stats(quality.feature_stats(current, names), baseline), "drift-stats")
    sinks.write_report(report, reports, "drift_stats", run_id)
    return drift.drift_status(report).first()["STATUS"]


@_job
def watch_drift_stats(
    baseline: DataFrame, reports: str, run_id: str, current: DataFrame | None = None, **thresholds: float,
) -> str:
    """Statistics against statistics: two stored documents, or the baseline against itself as a trial run."""
    stats = drift.stats_of_baseline(baseline if current is None else current)
    report = stage(drift.drift_stats_vs_stats(stats, baseline, **thresholds), "drift-documents")
    sinks.write_report(report, reports, "drift_stats", run_id)
    return drift.drift_status(report).first()["STATUS"]


@_job
def explain_clusters(
    spark: SparkSession, customers: DataFrame, models_path: str, out: str, run_id: str, run_timestamp: str,
    segment_prefix: str = "", background_fraction: float = 1.0, max_rows: int = 0, segment_col: str = "SEGMENT",
) -> int:
    """Explains the clusters of the selected segments; writes the table and per-segment JSON records.

    Segments whose model names an input table, columns, a label column or a target table are explained with these; rows for
    a target table go there too. Returns the number of rows.
    """
    models = explain.select_segments(bundle.open_run(spark, models_path, run_id), segment_prefix)
    models = stage(models.where(F.col("status") == "CLUSTERED"), "selected-models")
    shap = explain.explain_models(customers, models, run_id, run_timestamp, background_fraction, max_rows, segment_col)
    shap = stage(shap, "explanations")
    if shap.isEmpty():
        return 0
    for target in [r["TARGET"] for r in shap.where("TARGET is not null").select("TARGET").distinct().collect()]:
        sinks.append_explanations(spark, shap.where(F.col("TARGET") == target), target)
    rows = sinks.write_run(shap.drop("TARGET"), f"{out}/cluster_shap", run_id)
    written = spark.read.parquet(f"{out}/cluster_shap").where(F.col("RUN_ID") == sinks.safe_run_id(run_id))
    sinks.write_explanations(written.drop("RUN_ID"), f"{out}/cluster_shap_json/{sinks.safe_run_id(run_id)}")
    return rows
