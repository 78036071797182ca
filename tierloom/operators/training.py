"""Training of all segments in one go: scaler, k-means grid, silhouette, choice, model table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.operators import customers as cust
from tierloom.operators import kmeans, scaling, selection
from tierloom.operators.silhouette import silhouette
from tierloom.schemas import DEFAULT_FEATURES
from tierloom.sources.staging import stage


@dataclass(frozen=True)
class TrainingOptions:
    features: Sequence[str] = tuple(DEFAULT_FEATURES)
    industries: Sequence[str] = ()
    segment_col: str = "SEGMENT"
    clusters_min: int = 2
    clusters_max: int = 10
    min_customers: int = 60
    max_rows_per_industry: int = 0
    restarts: int = 10
    seed: int = 42
    max_iter: int = 300
    tol: float = 1e-4
    batch_size: int = 1024
    mini_batch_over: int | None = 20_000
    quantile_accuracy: int = 10_000


@dataclass(frozen=True)
class TrainedSegments:
    """Staged tables of a training run."""

    ready: DataFrame
    scaler: DataFrame
    points: DataFrame
    models: DataFrame


def training_points(customers: DataFrame, opts: TrainingOptions) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(readiness, scaler, weighted points) of the segments that may be clustered."""
    rows = cust.training_rows(customers, opts.features, opts.industries, opts.segment_col)
    rows = stage(cust.cap_per_industry(rows, opts.max_rows_per_industry), "training-rows")
    absent = bool(cust.missing_features(customers, opts.features))
    ready = stage(
        cust.readiness(cust.segment_sizes(rows), opts.min_customers, absent, opts.clusters_min, opts.clusters_max),
        "readiness")
    usable = rows.where("USABLE").join(ready.where("STATUS = 'READY'").select("SEGMENT_KEY"), "SEGMENT_KEY")
    if absent:
        usable = usable.withColumns({f: F.lit(None).cast("double") for f in cust.missing_features(rows, opts.features)})
    train = usable.select("CUSTOMER_ID", "SEGMENT_KEY", *opts.features)
    scaler = stage(scaling.robust_scaler(train, opts.features, opts.quantile_accuracy), "scaler")
    points = stage(kmeans.weighted_points(scaling.scaled_rows(train, scaler, opts.features)), "points")
    return ready, scaler, points


def fit_segments(customers: DataFrame, opts: TrainingOptions = TrainingOptions()) -> TrainedSegments:
    """Fits every k of every segment."""
    ready, scaler, points = training_points(customers, opts)
    models = kmeans.fit(
        points, ready.where("STATUS = 'READY'"), len(opts.features), opts.clusters_max, opts.restarts, opts.seed,
        opts.max_iter, opts.tol, opts.batch_size, opts.mini_batch_over)
    return TrainedSegments(ready, scaler, points, stage(models, "fitted"))


def choose_models(
    trained: TrainedSegments, opts: TrainingOptions, run_id: str, run_timestamp: str, input_table: str | None = None,
) -> DataFrame:
    """Scores every k by silhouette and returns the model table of the run."""
    labelled = kmeans.label_points(trained.points, trained.models, len(opts.features))
    scores = stage(silhouette(labelled), "silhouettes")
    status = cust.segment_status(trained.ready, selection.best_k(scores))
    return selection.model_table(
        status, scores, trained.models, trained.scaler, opts.features, run_id, run_timestamp, input_table)


def train(
    customers: DataFrame, run_id: str, run_timestamp: str, opts: TrainingOptions = TrainingOptions(),
    input_table: str | None = None,
) -> DataFrame:
    return choose_models(fit_segments(customers, opts), opts, run_id, run_timestamp, input_table)
