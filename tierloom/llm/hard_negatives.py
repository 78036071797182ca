"""Hard negatives by segment summary filtering: bounds of scores from means and deviations of vector segments.

A vector is cut into segments; of each its mean m and deviation s (root of the summed squared distances from the mean) are
kept. With n components to a segment the inner product of two segments lies within n m m' +- s s', so sums over the
segments bound a score from both sides. Bounds start with one segment a vector and are refined, 1, 4, 16 segments, for the
pairs still undecided; only pairs that survive all levels are scored exactly. A pair is dropped if its upper bound is
below the least score that can still matter to its anchor, or its lower bound above the greatest.

Anchors come in groups of at most `group_bytes`, which are sent to all tasks; every task runs its own rows past them,
so vectors are shuffled once, to find repeated rows, and never copied for each group. A first run over a hashed share of the rows
(`seed_share`) gives each anchor the score its k-th best has at least, so tasks report what can be among the best k of
all rows and not the best of their own share. Results are exact: seeds, bounds and blocks change the work only.

Scores are integers; they are exact in floating point below 2^53, as 64-bit integers up to 2^63, and beyond the query
fails with an ArithmeticError.

Cases: rows with a null id, a null label, a null vector or null or non-finite components take no part, nor do those
whose length is not that of the most vectors (the smallest such length); zero vectors do, with score 0; identical rows
count once; rows of the anchor's own id are not its candidates; ties rank by smaller id; an anchor without positives,
and a positive without negatives in range (any of a negative score), give no rows; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierloom.sources.staging import stage

LEVELS = (1, 4, 16)
TILE_ANCHORS, TILE_ROWS = 1024, 4096
_NO = np.iinfo(np.int64).min


def summaries(vectors: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Per segment: mean times the root of its length, and deviation. Sums of products give the bounds."""
    edges = np.linspace(0, vectors.shape[1], min(segments, vectors.shape[1]) + 1).astype(np.int64)[:-1]
    length = np.diff(np.r_[edges, vectors.shape[1]])
    total = np.add.reduceat(vectors, edges, axis=1)
    means = total / length
    spread = vectors - np.repeat(means, length, axis=1)
    return means * np.sqrt(length), np.sqrt(np.add.reduceat(spread ** 2, edges, axis=1))


@dataclass
class Summarised:
    """Integer vectors with their summaries at each level."""

    exact: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    norm: np.ndarray | None = None

    @staticmethod
    def of(vectors: np.ndarray, wide: bool) -> Summarised:
        if not vectors.shape[1]:
            vectors = np.zeros((len(vectors), 1))
        levels = [summaries(vectors, s) for s in LEVELS]
        return Summarised(vectors.astype(np.int64) if wide else vectors, levels, np.linalg.norm(vectors, axis=1))

    def take(self, rows) -> Summarised:
        return Summarised(self.exact[rows], [(m[rows], s[rows]) for m, s in self.levels], self.norm[rows])


def _products(a: np.ndarray, b: np.ndarray, row: np.ndarray | None, col: np.ndarray | None, share: float = 0.1):
    """Inner products of the pairs (row, col), all pairs if row is None; by one matrix product if they are many."""
    if row is None:
        return a @ b.T
    if len(row) > share * len(a) * len(b):
        return (a @ b.T)[row, col]
    return np.einsum("nd,nd->n", a[row], b[col])


def survivors(
    anchors: Summarised, rows: Summarised, allowed: np.ndarray, least: np.ndarray, most: np.ndarray,
    counts: list[int] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """anchor, row and exact score of the allowed pairs with least <= score <= most (both per anchor)."""
    row = col = None
    slack = 1e-9 * (1 + anchors.norm[:, None] * rows.norm.max(initial=0.0))
    low, high = least - slack[:, 0], most + slack[:, 0]
    for (m, s), (m2, s2) in zip(anchors.levels, rows.levels, strict=True):
        middle, reach = _products(m, m2, row, col), _products(s, s2, row, col)
        if row is None:
            row, col = np.nonzero(allowed & (middle + reach >= low[:, None]) & (middle - reach <= high[:, None]))
        else:
            stay = (middle + reach >= low[row]) & (middle - reach <= high[row])
            row, col = row[stay], col[stay]
        if counts is not None:
            counts.append(len(row))
        if not len(row):
            break
    score = _products(anchors.exact, rows.exact, row, col).astype(np.int64)
    stay = (score >= least[row]) & (score <= most[row])
    return row[stay], col[stay], score[stay]


class Best:
    """The k best of each list (an anchor's, or one of its bands'): greater score first, then smaller id."""

    def __init__(self, floors: np.ndarray, k: int):
        self.k, self.floors = k, floors.copy()  # floors: the least score that may still enter a list
        self.of, self.score, self.id = (np.empty(0, dtype=np.int64) for _ in range(3))

    def add(self, of: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        enters = score >= self.floors[of]
        if not enters.any():
            return
        of, score, ids = (np.r_[a, b[enters]] for a, b in ((self.of, of), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, of))
        of, score, ids = of[order], score[order], ids[order]
        start = np.r_[True, of[1:] != of[:-1]]
        place = np.arange(len(of)) - np.maximum.accumulate(np.where(start, np.arange(len(of)), 0))
        stay = place < self.k
        self.of, self.score, self.id = of[stay], score[stay], ids[stay]
        full = place == self.k - 1
        self.floors[of[full]] = np.maximum(self.floors[of[full]], score[full])


@dataclass
class Group:
    """Anchors that are searched together, and the lists they want: list i of anchor `owner[i]` takes low .. high."""

    id: np.ndarray
    label: np.ndarray
    vectors: Summarised
    same_label: bool
    owner: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def tiles(self):
        """Anchors of one label at a time if only that label counts, at most TILE_ANCHORS; with the lists of each."""
        order = np.argsort(self.label, kind="stable") if self.same_label else np.arange(len(self.id))
        label = self.label[order]
        cuts = np.flatnonzero(label[1:] != label[:-1]) + 1 if self.same_label else []
        for part in np.split(order, cuts):
            for i in range(0, len(part), TILE_ANCHORS):
                yield part[i:i + TILE_ANCHORS]


def search(group: Group, best: Best, ids: np.ndarray, labels: np.ndarray, rows: Summarised) -> None:
    """Runs the rows past the anchors of the group."""
    lists = np.argsort(group.owner, kind="stable")
    first = np.searchsorted(group.owner[lists], np.arange(len(group.id) + 1))
    for at in group.tiles():
        chosen = np.flatnonzero(labels == group.label[at[0]]) if group.same_label else np.arange(len(ids))
        n_lists = first[at + 1] - first[at]
        at, n_lists = at[n_lists > 0], n_lists[n_lists > 0]
        if not len(at) or not len(chosen):
            continue
        own = np.concatenate([lists[first[a]:first[a + 1]] for a in at])
        of = np.repeat(np.arange(len(at)), n_lists)
        begin = np.r_[0, np.cumsum(n_lists)[:-1]]
        floor = np.maximum(best.floors[own], group.low[own])
        least, most = np.minimum.reduceat(floor, begin), np.maximum.reduceat(group.high[own], begin)
        allowed = ids[None, chosen] != group.id[at, None]
        if not group.same_label:
            allowed &= labels[None, chosen] != group.label[at, None]
        a, r, score = survivors(group.vectors.take(at), rows.take(chosen), allowed, least, most)
        for j in range(n_lists.max()):
            # The j-th list of each anchor, for all anchors that have one.
            has = n_lists[a] > j
            where = own[np.minimum(begin[a] + j, len(own) - 1)]
            fits = has & (score >= group.low[where]) & (score <= group.high[where])
            best.add(where[fits], score[fits], ids[chosen[r[fits]]])


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dims)


def integer_rows(
    vectors: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int, moved_every: int, classes: int,
) -> DataFrame:
    """id, label, v (whole numbers): the different rows that take part."""
    v, i, label = (F.col(f"`{c}`") for c in (vector_col, id_col, label_col))
    rows = vectors.where(i.isNotNull() & label.isNotNull() & v.isNotNull()).select(
        i.cast("long").alias("id"), label.cast("long").alias("label"), v.cast("array<double>").alias("v"))
    rows = rows.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    length = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    moved = F.when(F.col("id") % moved_every == 0, (F.col("label") + 1) % classes).otherwise(F.col("label"))
    return rows.where(F.size("v") == (length["d"] if length else 0)).select("id", moved.alias("label"), "v").distinct()


def mine(
    vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low_percent: int = 50,
    high_percent: int = 95, scale: int = 256, moved_every: int = 7, classes: int = 10, group_bytes: int = 32 << 20,
    seed_share: int = 32, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score (all long but rank).

    Anchors are the rows whose id is divisible by `every`. Of a positive with score p the negatives score within
    low_percent and high_percent of p.
    """
    spark = vectors.sparkSession
    context = spark.sparkContext
    rows = stage(integer_rows(vectors, id_col, label_col, vector_col, scale, moved_every, classes), "integer_rows")
    shape = rows.agg(
        F.max(F.size("v")).alias("dims"), F.count("*").alias("n"),
        F.max(F.expr(f"aggregate(v, 0D, (s, x) -> s + (abs(x) * {scale} + 1) * (abs(x) * {scale} + 1))")).alias("most")).first()
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not shape["n"]:
        return spark.createDataFrame([], result)
    dims, wide = shape["dims"], shape["most"] >= 2.0 ** 52
    if shape["most"] >= 2.0 ** 62:
        raise ArithmeticError(f"scores up to {shape['most']:.3g} do not fit in a long")

    def whole(matrix: np.ndarray) -> Summarised:
        return Summarised.of(np.floor(scale * matrix), wide)

    def run(some: DataFrame, group: Group, floors: np.ndarray, k: int, name: str) -> DataFrame:
        """list, id, score, place: the k best of each list of the group among `some` rows, at least at their floors."""
        sent = context.broadcast((group, floors))

        def work(batches):
            group, floors = sent.value
            best = Best(floors, k)
            for batch in batches:
                for at in range(0, batch.num_rows, TILE_ROWS):
                    part = batch.slice(at, TILE_ROWS)
                    search(group, best, part.column(0).to_numpy(), part.column(1).to_numpy(), whole(_matrix(part.column(2), dims)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(best.of), pa.array(best.id), pa.array(best.score)], names=["list", "id", "score"])

        order = Window.partitionBy("list").orderBy(F.desc("score"), "id")
        found = some.mapInArrow(work, "list long, id long, score long")
        return stage(found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k), name)

    sample = rows.where(F.pmod(F.xxhash64("id", "v"), F.lit(seed_share)) == 0)

    def best_lists(group: Group, k: int, name: str) -> DataFrame:
        floors = group.low.copy()
        for r in run(sample, group, floors, k, f"{name}_seed").where(F.col("place") == k).collect():  # one a list
            floors[r["list"]] = max(floors[r["list"]], r["score"])
        return run(rows, group, floors, k, name)

    anchors = rows.where(F.col("id") % every == 0)
    groups = max(1, math.ceil(anchors.count() * max(1, dims) * 8 / group_bytes))
    parts = []
    for g in range(groups):
        # At most about group_bytes of vectors, which the driver passes on to all tasks.
        own = anchors.where(F.pmod(F.xxhash64("id", "v", F.lit(1)), F.lit(groups)) == g).orderBy("id").toArrow()
        if not own.num_rows:
            continue
        ids, labels = own["id"].to_numpy(), own["label"].to_numpy()
        points = whole(_matrix(own["v"].combine_chunks(), dims))
        n = len(ids)
        everything = np.full(n, _NO + 1), np.full(n, -(_NO + 1))
        near = best_lists(Group(ids, labels, points, True, np.arange(n), *everything), positives, "positives").orderBy(
            "list", "place").toArrow()  # `positives` rows an anchor of the group
        owner, score = near["list"].to_numpy(), near["score"].to_pylist()
        low = np.array([-(-low_percent * s // 100) for s in score], dtype=np.int64)
        high = np.array([high_percent * s // 100 for s in score], dtype=np.int64)
        bands = Group(ids, labels, points, False, owner, low, high)
        if not len(owner):
            continue
        far = best_lists(bands, negatives, "negatives")
        table = pa.table({
            "list": pa.array(np.arange(len(owner))), "anchor_id": pa.array(ids[owner]), "positive_id": near["id"],
            "positive_score": near["score"]})
        parts.append(far.join(F.broadcast(spark.createDataFrame(table)), "list").select(
            "anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score")))
    if not parts:
        return spark.createDataFrame([], result)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found
