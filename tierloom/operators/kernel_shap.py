"""KernelSHAP for any score of a scaled feature vector, as a weighted regression over feature coalitions.

A coalition says which features a row keeps; the others take the values of background rows. The score of a coalition is
its mean over the background. Up to `most_coalitions` all coalitions are taken, which makes the Shapley values exact;
beyond, they are drawn in pairs of complements with the kernel's probability of their size. As all rows share the
coalitions, the least-squares solution, constrained to add up to the score of the row less that of the background, is a
fixed linear map of the coalition scores, so a row's values are sums of columns. The normal equations are also summed up
per (segment, cluster) and solved there, which gives the mean contribution with its sign: those sums merge over tasks,
partitions and runs.

The regression of an additive score needs no coalitions: any that determine it give each feature its own term less the
term's background mean, which is what is taken then (Additive), at a cost that neither coalitions nor background enter.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.functions.sampling import hash_order
from tierloom.operators.explain import background_moments
from tierloom.operators.topn import top_n_per_group
from tierloom.sources.staging import stage, with_size_check

# SQL of a score from SQL of the features' values; it may use the columns centroids and CLUSTER_LABEL.
Score = Callable[[Sequence[str]], str]


def _distance(values: Sequence[str], centre: str) -> str:
    return " + ".join(f"({x} - {centre}[{j}]) * ({x} - {centre}[{j}])" for j, x in enumerate(values))


@dataclass(frozen=True)
class Additive:
    """A score that sums up a term a feature. term: SQL from the feature's value and number; mean: SQL of its mean over rows,
    from the means of value and squared value, and the number."""

    term: Callable[[str, int], str]
    mean: Callable[[str, str, int], str]

    def __call__(self, values: Sequence[str]) -> str:
        return " + ".join(self.term(x, j) for j, x in enumerate(values))


_OWN = "get(centroids, CLUSTER_LABEL)"
# Squared distance to the row's own centre.
own_distance = Additive(
    lambda x, j: f"({x} - {_OWN}[{j}]) * ({x} - {_OWN}[{j}])",
    lambda m1, m2, j: f"({m2} - 2 * {_OWN}[{j}] * {m1} + {_OWN}[{j}] * {_OWN}[{j}])")


def margin(values: Sequence[str]) -> str:
    """How much farther the closest other centre is than the own one (squared): not additive."""
    others = f"array_min(transform(centroids, (ctr, pos) -> if(pos = CLUSTER_LABEL, null, {_distance(values, 'ctr')})))"
    return f"coalesce({others} - ({own_distance(values)}), 0D)"


def coalitions(dims: int, most: int = 510, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Rows of kept features (0 / 1) without the empty and the full coalition, and their weights."""
    if 2 ** dims - 2 <= most:
        kept = (np.arange(1, 2 ** dims - 1)[:, None] >> np.arange(dims)) & 1
        size = kept.sum(axis=1)
        return kept, np.array([(dims - 1) / (math.comb(dims, s) * s * (dims - s)) for s in size.tolist()])
    r = np.random.default_rng(seed)
    sizes = np.arange(1, dims)
    chance = 1 / (sizes * (dims - sizes))
    drawn = np.zeros((most // 2, dims), dtype=np.int64)
    for row, size in zip(drawn, r.choice(sizes, size=len(drawn), p=chance / chance.sum()), strict=True):
        row[r.choice(dims, size=size, replace=False)] = 1
    kept, times = np.unique(np.concatenate([drawn, 1 - drawn]), axis=0, return_counts=True)
    return kept, times.astype(np.float64)


def design(kept: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """X'W and X'WX of the regression without its last feature, which the constraint gives."""
    x = (kept[:, :-1] - kept[:, -1:]).astype(np.float64)
    return x.T * weight, (x.T * weight) @ x


def solved(kept: np.ndarray, xtw: np.ndarray, xtwx: np.ndarray) -> np.ndarray:
    """feature x (coalition..., full): contribution of each coalition's gain, and of the full coalition's."""
    inverse = np.linalg.lstsq(xtwx, xtw, rcond=None)[0]
    first = np.column_stack([inverse, -inverse @ kept[:, -1]])
    last = -first.sum(axis=0)
    last[-1] += 1.0
    return np.vstack([first, last])


def kernel_shap(
    labelled: DataFrame, models: DataFrame, features: Sequence[str], run_id: str, run_timestamp: str,
    score: Score = own_distance, background_rows: int = 100, max_rows: int = 0, most_coalitions: int = 510, seed: int = 42,
) -> DataFrame:
    """SEGMENT, CLUSTER, CLUSTER_SHAP (feature -> mean absolute contribution), CLUSTER_MEAN (feature -> mean contribution),
    BASE (mean score of the background), FULL (mean score of the rows), RUNID, RUNTIMESTAMP.

    Of each segment `background_rows` rows by hash are the background, so the context of a segment has a fixed size;
    max_rows (0: all) bounds the rows that are explained. `labelled` comes from scaled_labelled, best staged. The values of
    CLUSTER_MEAN add up to FULL - BASE.
    """
    dims = len(features)
    names = F.array(*[F.lit(f) for f in features])
    if isinstance(score, Additive):
        sums = _additive_sums(labelled, models, dims, score, background_rows, max_rows)
        return _explained(sums, names, run_id, run_timestamp)
    if dims == 1:
        kept, weight = np.zeros((0, 1), dtype=np.int64), np.zeros(0)
    else:
        kept, weight = coalitions(dims, most_coalitions, seed)
    xtw, xtwx = design(kept, weight)
    background = _first_rows(labelled, background_rows).groupBy("SEGMENT_KEY").agg(
        F.array_sort(F.collect_list("Z")).alias("__bg"))
    context = stage(background.join(
        models.select(F.col("segment_key").alias("SEGMENT_KEY"), "centroids"), "SEGMENT_KEY"), "explain-context")
    if max_rows > 0:
        labelled = _first_rows(labelled, max_rows)

    def value(row: Sequence[int]) -> str:
        mixed = score([f"Z[{j}]" if k else f"b[{j}]" for j, k in enumerate(row)])
        return f"aggregate(__bg, 0D, (total, b) -> total + ({mixed})) / size(__bg)"

    rows = labelled.join(with_size_check(context), "SEGMENT_KEY").select(
        "SEGMENT_KEY", "CLUSTER_LABEL", F.expr(value([0] * dims)).alias("__base"), F.expr(score([f"Z[{j}]" for j in range(dims)])).alias("__full"),
        F.expr(f"cast(array({', '.join(value(row) for row in kept.tolist())}) as array<double>)").alias("__v"))

    def weighted(numbers: Sequence[float]) -> str:
        """Sum of coalition gains, the full coalition's last, times the numbers."""
        *each, full = numbers
        vector = ", ".join(f"{x!r}D" for x in map(float, each))
        parts = f"aggregate(zip_with(__v, cast(array({vector}) as array<double>), (v, m) -> (v - __base) * m), 0D, (t, x) -> t + x)"
        return f"{parts} + (__full - __base) * {float(full)!r}D"

    # X'Wy of a row: y of a coalition is its gain less the full gain if it keeps the last feature.
    totals = [weighted([*line, -float(line @ kept[:, -1])]) for line in xtw]
    sums = rows.groupBy("SEGMENT_KEY", "CLUSTER_LABEL").agg(
        F.count(F.lit(1)).alias("N"), F.sum("__base").alias("BASE"), F.sum("__full").alias("FULL"),
        F.array(*[F.avg(F.abs(F.expr(weighted(line)))) for line in solved(kept, xtw, xtwx)]).alias("MEAN_ABS"),
        F.array(*[F.sum(F.expr(t)) for t in totals]).cast("array<double>").alias("XTWY"))
    return _explained(solve(sums, xtwx), names, run_id, run_timestamp)


def _first_rows(labelled: DataFrame, rows: int) -> DataFrame:
    """The first rows of each segment by hash."""
    return top_n_per_group(labelled, ["SEGMENT_KEY"], [hash_order("CUSTOMER_ID"), F.col("CUSTOMER_ID")], rows)


def _explained(sums: DataFrame, names: Column, run_id: str, run_timestamp: str) -> DataFrame:
    return sums.select(
        F.col("SEGMENT_KEY").alias("SEGMENT"), F.col("CLUSTER_LABEL").alias("CLUSTER"),
        F.map_from_arrays(names, "MEAN_ABS").alias("CLUSTER_SHAP"), F.map_from_arrays(names, "MEAN").alias("CLUSTER_MEAN"),
        (F.col("BASE") / F.col("N")).alias("BASE"), (F.col("FULL") / F.col("N")).alias("FULL"),
        F.lit(run_id).alias("RUNID"), F.lit(run_timestamp).alias("RUNTIMESTAMP"))


def _additive_sums(
    labelled: DataFrame, models: DataFrame, dims: int, score: Additive, background_rows: int, max_rows: int,
) -> DataFrame:
    """SEGMENT_KEY, CLUSTER_LABEL, N, BASE, FULL, MEAN_ABS, MEAN of a score that is additive."""
    moments = background_moments(_first_rows(labelled, background_rows), dims, 1.0)
    context = stage(moments.join(
        models.select(F.col("segment_key").alias("SEGMENT_KEY"), "centroids"), "SEGMENT_KEY"), "explain-context")
    if max_rows > 0:
        labelled = _first_rows(labelled, max_rows)
    terms = [score.term(f"Z[{j}]", j) for j in range(dims)]
    means = [score.mean(f"M1[{j}]", f"M2[{j}]", j) for j in range(dims)]
    gains = [F.expr(f"{t} - {m}") for t, m in zip(terms, means, strict=True)]
    return labelled.join(with_size_check(context), "SEGMENT_KEY").groupBy("SEGMENT_KEY", "CLUSTER_LABEL").agg(
        F.count(F.lit(1)).alias("N"), F.sum(F.expr(" + ".join(means))).alias("BASE"), F.sum(F.expr(" + ".join(terms))).alias("FULL"),
        F.array(*[F.avg(F.abs(g)) for g in gains]).alias("MEAN_ABS"), F.array(*[F.avg(g) for g in gains]).alias("MEAN"))


def solve(sums: DataFrame, xtwx: np.ndarray) -> DataFrame:
    """sums with MEAN: the solution of the normal equations (N times xtwx against XTWY) of each row, constrained to add up
    to FULL - BASE."""
    inverse = np.linalg.pinv(xtwx) if len(xtwx) else np.zeros((0, 0))

    def work(batches):
        for batch in batches:
            n, base, full = (batch.column(c).to_numpy() for c in ("N", "BASE", "FULL"))
            right = batch.column("XTWY").flatten().to_numpy().reshape(batch.num_rows, -1)
            first = right @ inverse.T / n[:, None]
            mean = np.column_stack([first, (full - base) / n - first.sum(axis=1)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(mean.tolist(), pa.list_(pa.float64()))], [*batch.schema.names, "MEAN"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sums.schema)
    return sums.mapInArrow(work, f"{schema}, MEAN array<double>")
