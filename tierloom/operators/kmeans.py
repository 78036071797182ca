"""k-means for all segments, all k and all restarts at once.

Rows stay distributed as chunks of packed points (kmeans_chunks). What moves are drawn candidates and partial sums per
(segment, k, restart, label). Centres live in a staged table, joined by segment key, so nothing passes through the driver
but the number of models that still move.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tierloom.functions.vectors import nearest
from tierloom.operators import kmeans_chunks as kc
from tierloom.sources.staging import stage, with_size_check

MODEL = ["SEGMENT_KEY", "K", "RESTART"]


def weighted_points(rows: DataFrame) -> DataFrame:
    """SEGMENT_KEY, Z, W, POINT_ID: equal vectors of a segment become one weighted point.

    Exact for k-means and silhouette, and it folds a hot group of copies map-side.
    """
    return rows.where(F.col("Z").isNotNull()).groupBy("SEGMENT_KEY", "Z").agg(
        F.count(F.lit(1)).alias("W"), F.min("CUSTOMER_ID").alias("POINT_ID"))


def assign(points: DataFrame, models: DataFrame, dims: int | None, most: int | None = None) -> DataFrame:
    """Every point with its LABEL and D2 under every model of its segment; no model has more than `most` centres."""
    return (
        points.join(with_size_check(models.select(*MODEL, "CENTERS")), "SEGMENT_KEY")
        .withColumn("NEAR", F.expr(nearest("Z", "CENTERS", dims, most)))
        .select(*MODEL, "Z", "W", F.col("NEAR.label").alias("LABEL"), F.col("NEAR.d2").alias("D2"))
    )


def cluster_sums(assigned: DataFrame, dims: int) -> DataFrame:
    """MODEL, LABEL, N, MEAN (array), INERTIA. Only these partial sums are shuffled."""
    sums = assigned.groupBy(*MODEL, "LABEL").agg(
        F.expr("sum(W) as N"), F.expr("sum(W * D2) as INERTIA"),
        *[F.expr(f"sum(W * Z[{j}]) as __s{j}") for j in range(dims)])
    # Rounded, so that the order in which partial sums arrive does not show.
    mean = ", ".join(f"round(__s{j} / N, 12)" for j in range(dims))
    return sums.select(*MODEL, "LABEL", "N", F.expr(f"array({mean}) as MEAN"), "INERTIA")


def tolerances(points: DataFrame, tol: float, dims: int) -> DataFrame:
    """SEGMENT_KEY, TOL: tol times the mean feature variance, against the summed centre shift."""
    parts = " + ".join(
        f"sum(W * Z[{j}] * Z[{j}]) / sum(W) - pow(sum(W * Z[{j}]) / sum(W), 2)" for j in range(dims))
    return points.groupBy("SEGMENT_KEY").agg(F.expr(f"greatest({parts}, 0D) / {dims} * {tol!r}D as TOL"))


def iterate(
    chunks: DataFrame, seeds: DataFrame, limits: DataFrame, dims: int, max_iter: int, carry_bounds: bool = False,
) -> DataFrame:
    """MODEL, CENTERS, ITERATIONS, DISTANCES: Lloyd's rounds over segments of several chunks.

    Each round shares the sums of all chunks; models that have settled leave. With carry_bounds the label and two bounds
    of every point and model are written beside the points each round, and distances are computed only where the bounds
    leave a choice: worth it where a distance costs more than storing 20 bytes, with long vectors and many centres.
    DISTANCES is then the number computed for the segment, else null.
    """
    models = stage(
        seeds.join(limits, "SEGMENT_KEY").withColumns({
            "BEFORE": F.col("CENTERS"), "SHIFT": F.lit(0.0), "DONE": F.lit(False), "ITERATIONS": F.lit(0)}), "models")
    state = chunks.withColumn("STATE", F.array().cast(kc._STATE))
    spent = None
    for iteration in range(1, max_iter + 1):
        active, settled = models.where("NOT DONE"), models.where("DONE")
        if carry_bounds:
            state = stage(kc.carried_sums(state, active), "bounds")
            parts = state.select("SEGMENT_KEY", F.inline("SUMS"))
            cost = state.groupBy("SEGMENT_KEY").agg(F.sum("DISTANCES").alias("DISTANCES"))
            spent = stage((cost if spent is None else spent.unionByName(cost)).groupBy("SEGMENT_KEY").agg(
                F.sum("DISTANCES").alias("DISTANCES")), "distances")
        else:
            parts = kc.chunk_sums(chunks, active)
        # A settled model keeps the centres that the round moved so little, as the moved ones might make a larger step again.
        small = F.col("SHIFT") <= F.col("TOL")
        stepped = kc.moved(active, kc.merged_means(parts, dims), dims).withColumns({
            "CENTERS": F.when(small, F.col("BEFORE")).otherwise(F.col("CENTERS")), "DONE": small,
            "ITERATIONS": F.lit(iteration)}).select(*models.columns)
        moving = Observation()
        models = stage(
            stepped.unionByName(settled).observe(moving, F.count_if(~F.col("DONE")).alias("n")), "models")
        if moving.get["n"] == 0:
            break
    result = models.select(*MODEL, "CENTERS", "ITERATIONS")
    return result.withColumn("DISTANCES", F.lit(None).cast("long")) if spent is None else result.join(spent, "SEGMENT_KEY")


def fit(
    points: DataFrame, candidates: DataFrame, dims: int, clusters_max: int = 10, restarts: int = 10, seed: int = 42,
    max_iter: int = 300, tol: float = 1e-4, batch_size: int = 1024, mini_batch_over: int | None = 20_000,
    chunk_rows: int | None = None, carry_bounds: bool = False,
) -> DataFrame:
    """Best model per (SEGMENT_KEY, K): CENTERS, INERTIA, ITERATIONS, RESTART.

    `points` is a staged weighted_points table, `candidates` has SEGMENT_KEY, K_LO, K_HI. Segments with more than
    mini_batch_over rows (None: never) are fitted on max_iter mini-batches of about batch_size rows, drawn once; of the
    others those of one chunk (chunk_rows points) are iterated to the end in a task, and larger ones round by round.
    """
    chunk_rows = chunk_rows or max(256, min(20_000, (4 << 20) // (8 * (dims + 2))))
    plan = kc.Plan(clusters_max, restarts, seed, max_iter, oversample=2 * clusters_max)
    wanted = candidates.where("K_HI >= K_LO").select("SEGMENT_KEY", "K_LO", "K_HI")
    kind = F.when(F.col("N") > (mini_batch_over if mini_batch_over is not None else float("inf")), "batch").when(
        F.col("CHUNKS") == 1, "small").otherwise("large")
    chunks = stage(kc.packed(points, chunk_rows).withColumn("KIND", kind), "chunks", row_group_bytes=16 << 20)
    kinds = chunks.select("SEGMENT_KEY", "KIND").distinct().join(wanted, "SEGMENT_KEY")
    counts = {r["KIND"]: r["count"] for r in kinds.groupBy("KIND").count().collect()}  # three rows
    parts = []
    if "small" in counts:
        parts.append(kc.fit_small(chunks.where("KIND = 'small'"), wanted, counts["small"], plan, tol))
    shared = chunks.where("KIND <> 'small'").join(kinds.select("SEGMENT_KEY"), "SEGMENT_KEY")
    if counts.keys() - {"small"}:
        several = wanted.join(kinds.where("KIND <> 'small'").select("SEGMENT_KEY", "KIND"), "SEGMENT_KEY")
        seeds = stage(kc.seed_large(shared, several, plan, dims).join(several.select("SEGMENT_KEY", "KIND"), "SEGMENT_KEY"), "seeds")
        fitted = []
        if "large" in counts:
            limits = stage(tolerances(points, tol, dims), "tolerances")
            fitted.append(iterate(
                shared.where("KIND = 'large'"), seeds.where("KIND = 'large'").drop("KIND"), limits, dims, max_iter, carry_bounds).drop("DISTANCES"))
        if "batch" in counts:
            fitted.append(kc.fit_mini_batch(shared.where("KIND = 'batch'"), seeds.where("KIND = 'batch'").drop("KIND"), batch_size, plan))
        made = stage(reduce(DataFrame.unionByName, fitted), "made")
        parts.append(made.join(kc.inertias(shared, made), MODEL))
    if not parts:
        return points.sparkSession.createDataFrame([], kc._FITTED)
    return best_restart(stage(reduce(DataFrame.unionByName, parts), "fits"))


def best_restart(models: DataFrame) -> DataFrame:
    """Lowest inertia per (segment, k); the smaller restart number wins a tie."""
    order = Window.partitionBy("SEGMENT_KEY", "K").orderBy(F.round("INERTIA", 9), "RESTART")
    return models.withColumn("__rank", F.row_number().over(order)).where("__rank = 1").select(
        *MODEL, "CENTERS", "INERTIA", "ITERATIONS")


def check(points: DataFrame, models: DataFrame, dims: int, tol: float) -> DataFrame:
    """SEGMENT_KEY, K, ROWS, INERTIA_AGREES, SETTLED, FALLS of fitted models, by one exact step over all points.

    INERTIA_AGREES: the recorded inertia is that of the centres. SETTLED: the step moves the centres by no more than a
    settled model's (ITERATIONS of models that were stopped are not looked at). FALLS: a model has no more inertia than
    that of the next smaller k.
    """
    sums = cluster_sums(assign(points, models, dims), dims)
    step = sums.groupBy(*MODEL).agg(
        F.sum("N").alias("ROWS"), F.sum("INERTIA").alias("MEASURED"),
        F.map_from_entries(F.collect_list(F.struct("LABEL", "MEAN"))).alias("MEANS"))
    limits = tolerances(points, tol, dims)
    judged = kc.moved(models, step.select(*MODEL, "MEANS"), dims).select(*MODEL, "INERTIA", "SHIFT").join(
        step.drop("MEANS"), MODEL).join(limits, "SEGMENT_KEY")
    smaller = F.lag("INERTIA").over(Window.partitionBy("SEGMENT_KEY").orderBy("K"))
    return judged.select(
        "SEGMENT_KEY", "K", "ROWS",
        (F.abs(F.col("INERTIA") - F.col("MEASURED")) <= 1e-6 * (1 + F.col("MEASURED"))).alias("INERTIA_AGREES"),
        (F.col("SHIFT") <= F.col("TOL") * 1.000001 + 1e-12).alias("SETTLED"),
        F.coalesce(F.col("INERTIA") <= smaller * 1.000001, F.lit(True)).alias("FALLS"))


def label_points(points: DataFrame, models: DataFrame, dims: int | None) -> DataFrame:
    """points with KS and LABELS: one label per k, both arrays ordered by k."""
    per_segment = models.groupBy("SEGMENT_KEY").agg(
        F.array_sort(F.collect_list(F.struct("K", "CENTERS"))).alias("__models"))
    return (
        points.join(with_size_check(stage(per_segment, "segment-models")), "SEGMENT_KEY")
        .withColumns({
            "KS": F.transform("__models", lambda m: m["K"]),
            "LABELS": F.expr(f"transform(__models, m -> ({nearest('Z', 'm.CENTERS', dims)}).label)"),
        })
        .drop("__models")
    )
