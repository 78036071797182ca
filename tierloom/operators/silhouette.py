"""Exact mean Euclidean silhouette per (segment, k), without forming pairs of rows.

The points of a segment are cut into blocks by hash. A task holds one block and streams the points of its
segment past it, adding distances into one running sum per (point, label); so a large segment is spread over
many tasks, each with bounded memory, and every point is used. Distances are shared by all k. The work is
quadratic in the distinct points of a segment, as the measure is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.sources.staging import stage

_TILE = 250_000
# Squares below this share of a squared length are measured by differences: the others keep ten digits at least.
_NEAR = 1e-5
_TILE_ROWS = 2048


def silhouette(labelled: DataFrame, block_rows: int = 4096, max_block_rows: int = 65_536) -> DataFrame:
    """SEGMENT_KEY, K, SILHOUETTE from rows SEGMENT_KEY, Z, W, KS, LABELS (Z distinct per segment).

    A point alone in its cluster counts 0; a k with a single label present scores -1. Every point is sent once to
    every block of its segment, so blocks grow (up to max_block_rows) once a segment has more of them than keep all cores busy.
    """
    cores = labelled.sparkSession.sparkContext.defaultParallelism
    points = labelled.select("SEGMENT_KEY", "Z", F.col("W").cast("double").alias("W"), "KS", "LABELS")
    blocks = stage(
        points.groupBy("SEGMENT_KEY").agg(
            F.expr(f"""cast(ceil(count(1) / least(
                greatest({block_rows}, ceil(count(1) / {4 * cores})), greatest({block_rows}, {max_block_rows}))) as int)
            """).alias("BLOCKS")),
        "silhouette-blocks")
    points = points.join(blocks, "SEGMENT_KEY")
    held = points.withColumns({
        "BLOCK": F.pmod(F.xxhash64("Z"), F.col("BLOCKS")).cast("int"), "ROLE": F.lit(0)})
    passing = points.withColumns({
        "BLOCK": F.explode(F.sequence(F.lit(0), F.col("BLOCKS") - 1)), "ROLE": F.lit(1)})
    streams = (
        held.unionByName(passing).drop("BLOCKS")
        .repartition(16 * cores, "SEGMENT_KEY", "BLOCK")  # given and many, so that few tasks get two blocks
        .sortWithinPartitions("SEGMENT_KEY", "BLOCK", "ROLE")
    )
    parts = streams.mapInArrow(_block_scores, "SEGMENT_KEY string, K int, TOTAL double, WEIGHT double")
    return parts.groupBy("SEGMENT_KEY", "K").agg(
        F.when(F.max("TOTAL").isNull(), -1.0)
        .otherwise(F.sum("TOTAL") / F.sum("WEIGHT")).alias("SILHOUETTE"))


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _extended(z: np.ndarray, origin: np.ndarray, left: bool) -> np.ndarray:
    """Vectors whose inner products (left side with right side) are squared distances."""
    z = z - origin
    square, one = np.einsum("ij,ij->i", z, z)[:, None], np.ones((len(z), 1))
    return np.hstack([z, square, one]) if left else np.hstack([-2 * z, one, square])


def _by_differences(a: np.ndarray, b: np.ndarray, out: np.ndarray) -> None:
    np.subtract(a[:, 0, None], b[None, :, 0], out=out)
    np.multiply(out, out, out=out)
    for j in range(1, a.shape[1]):
        diff = a[:, j, None] - b[None, :, j]
        np.multiply(diff, diff, out=diff)
        np.add(out, diff, out=out)


def _distances(a: np.ndarray, b: np.ndarray, left: np.ndarray, right: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of a and b, written into `out`; left and right: both extended.

    One matrix product gives the squares. It loses digits of near points, so squares that are small beside the lengths are
    taken again by differences.
    """
    total = np.matmul(left, right.T, out=out[:len(a), :len(b)])
    # Vectors that near have lengths of the same order, so one of the two lengths will do.
    near = total < (_NEAR * left[:, -2])[:, None]
    found = np.count_nonzero(near)
    if found > total.size >> 4:
        _by_differences(a, b, total)
    elif found:
        i, j = np.nonzero(near)
        diff = a[i] - b[j]
        total[i, j] = np.einsum("ij,ij->i", diff, diff)
    return np.sqrt(total, out=total)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of a and b, for tiles of bounded size."""
    origin = a.mean(axis=0)
    return _distances(a, b, _extended(a, origin, True), _extended(b, origin, False), np.empty((len(a), len(b))))


class _Block:
    """Running sums of one block: distance and weight per (k, label) slot."""

    def __init__(self, key: str):
        self.key, self.held, self.ready = key, [], False

    def hold(self, z, w, ks, labels):
        self.held.append((z, w, labels))
        self.ks = ks

    def open(self):
        self.z, self.w, self.labels = (np.concatenate(c) for c in zip(*self.held))
        self.starts = np.concatenate([[0], np.cumsum(self.ks)[:-1]]).astype(int)
        self.sums = np.zeros((len(self.z), int(self.ks.sum())))
        self.weights = np.zeros(int(self.ks.sum()))
        self.rows = min(len(self.z), _TILE_ROWS)
        self.step = max(8, _TILE // self.rows)
        self.origin = np.median(self.z, axis=0)
        self.left = _extended(self.z, self.origin, True)
        self.buffer = np.empty((self.rows, self.step))
        self.ready = True

    def stream(self, z, w, labels):
        if not self.held:
            return
        if not self.ready:
            self.open()
        slots = labels + self.starts[None, :]
        marks = np.zeros((len(z), self.sums.shape[1]))
        np.put_along_axis(marks, slots, np.repeat(w[:, None], slots.shape[1], axis=1), axis=1)
        self.weights += marks.sum(axis=0)
        right = _extended(z, self.origin, False)
        for i in range(0, len(z), self.step):
            near = slice(i, i + self.step)
            for k in range(0, len(self.z), self.rows):
                held = slice(k, k + self.rows)
                self.sums[held] += _distances(self.z[held], z[near], self.left[held], right[near], self.buffer) @ marks[near]

    def scores(self):
        if not self.ready:
            return
        rows = np.arange(len(self.z))
        for i, k in enumerate(self.ks):
            window = slice(self.starts[i], self.starts[i] + k)
            sums, weights, own = self.sums[:, window], self.weights[window], self.labels[:, i]
            if (weights > 0).sum() < 2:
                yield self.key, int(k), None, float(self.w.sum())
                continue
            with np.errstate(divide="ignore", invalid="ignore"):
                inner = sums[rows, own] / (weights[own] - 1)
                means = np.where(weights > 0, sums / weights, np.inf)
                means[rows, own] = np.inf
                outer = means.min(axis=1)
                s = (outer - inner) / np.maximum(inner, outer)
            s = np.where((weights[own] <= 1) | ~np.isfinite(s), 0.0, s)
            yield self.key, int(k), float((s * self.w).sum()), float(self.w.sum())


def _block_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["SEGMENT_KEY", "K", "TOTAL", "WEIGHT"]
    types = [pa.string(), pa.int32(), pa.float64(), pa.float64()]

    def emit(block):
        rows = list(block.scores()) if block else []
        cols = list(zip(*rows)) if rows else [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    current, current_id = None, None
    for batch in batches:
        if len(batch) == 0:
            continue
        keys = batch.column("SEGMENT_KEY")
        marks = [keys.dictionary_encode().indices, batch.column("BLOCK"), batch.column("ROLE")]
        marks = np.stack([m.to_numpy(zero_copy_only=False) for m in marks])
        cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
        for start, stop in zip([0, *cuts], [*cuts, len(batch)]):
            part = batch.slice(start, stop - start)
            z, labels = _vectors(part.column("Z")), _vectors(part.column("LABELS"))
            w = part.column("W").to_numpy(zero_copy_only=False)
            ident = (keys[int(start)].as_py(), int(marks[1, start]))
            if ident != current_id:
                if current is not None:
                    yield emit(current)
                current, current_id = _Block(ident[0]), ident
            if marks[2, start] == 0:
                current.hold(z, w, np.asarray(part.column("KS")[0].as_py()), labels)
            else:
                current.stream(z, w, labels)
    if current is not None:
        yield emit(current)
