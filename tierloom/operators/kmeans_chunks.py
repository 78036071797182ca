"""k-means on chunks of packed points: seeding by k-means||, Lloyd's rounds with carried bounds, mini-batches.

A chunk is a row with at most a few thousand points of one segment. Seeding takes a few oversampling passes instead of one
pass per centre: each pass draws `oversample` points for every (segment, restart) with probability proportional to weight
times squared distance, as the smallest keys -ln(u) / weight, so chunks report their smallest keys and no total is needed
first. The candidates, weighted by the points nearest to them, are then reduced to seeds of every k where they are few.

A segment that is one chunk is seeded and iterated to the end in its task; segments of several chunks share sums per round.
Both take the same steps. Bounds as carried in Lloyd's rounds (one upper bound to the own centre and one lower bound to
all others per point and model) skip the points that cannot change their centre.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.sources.staging import stage, with_size_check

MODEL = ["SEGMENT_KEY", "K", "RESTART"]
_VECTOR = pa.list_(pa.float64())
_CENTERS = pa.list_(_VECTOR)
# Bounds are compared with this much room, so that rounding never skips a point that might change.
_ROOM = 1e-9


@dataclass
class Points:
    """Distinct vectors z, their weights w and hashes h (which every draw is made from)."""

    z: np.ndarray
    w: np.ndarray
    h: np.ndarray

    @staticmethod
    def of(items: pa.Array) -> Points:
        flat = items.flatten()
        z = flat.field("Z").flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)
        return Points(z, flat.field("W").to_numpy(zero_copy_only=False).astype(np.float64), flat.field("H").to_numpy())


@dataclass(frozen=True)
class Plan:
    clusters_max: int = 10
    restarts: int = 10
    seed: int = 42
    max_iter: int = 300
    oversample: int = 20
    passes: int = 4


def draws(h: np.ndarray, *salts: int | np.ndarray) -> np.ndarray:
    """Uniform numbers in (0, 1), a function of hash and salts alone; an array salts each hash by its own number (0 or more)."""
    with np.errstate(over="ignore"):
        x = h.astype(np.uint64)
        for salt in salts:
            if isinstance(salt, np.ndarray):
                x = x + (salt.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            else:
                x = x + np.uint64((salt * 2 + 1) * 0x9E3779B97F4A7C15 % 2 ** 64)
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
            x = x ^ (x >> np.uint64(31))
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53


def squared_distances(z: np.ndarray, centres: np.ndarray) -> np.ndarray:
    total = np.zeros((len(z), len(centres)))
    for j in range(z.shape[1]):  # by differences: a tie stays a tie
        diff = z[:, j, None] - centres[None, :, j]
        total += diff * diff
    return total


def closest(z: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label and squared distance (run x row) of the closest centre of every run; centres: run x k x dims.

    Centre by centre over whole columns, which is several times faster than the minimum of each short row of a matrix.
    """
    runs, k, dims = centres.shape
    columns = np.ascontiguousarray(z.T)
    label, d2 = np.zeros((runs, len(z)), dtype=np.int64), np.full((runs, len(z)), np.inf)
    far, diff = np.empty_like(d2), np.empty_like(d2)
    for c in range(k):
        far.fill(0.0)
        for j in range(dims):  # by differences: a tie stays a tie
            np.subtract(columns[j], centres[:, c, j, None], out=diff)
            np.multiply(diff, diff, out=diff)
            np.add(far, diff, out=far)
        np.copyto(label, c, where=far < d2)
        np.minimum(d2, far, out=d2)
    return label, d2


def nearest(z: np.ndarray, centres: np.ndarray, block: int = 8192) -> tuple[np.ndarray, np.ndarray]:
    """Label and squared distance of the closest centre; the first one wins a tie."""
    if len(z) < 512:  # few rows: one small matrix takes fewer steps
        far = squared_distances(z, centres)
        return far.argmin(axis=1), far.min(axis=1)
    label, d2 = np.empty(len(z), dtype=np.int64), np.empty(len(z))
    for i in range(0, len(z), block):
        label[i:i + block], d2[i:i + block] = (x[0] for x in closest(z[i:i + block], centres[None]))
    return label, d2


def race(points: Points, centres: np.ndarray, take: int, plan: Plan, restart: int, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and vectors of the `take` points that win the draw; points on a centre are out of it."""
    weight = points.w if not len(centres) else points.w * nearest(points.z, centres)[1]
    with np.errstate(divide="ignore"):
        key = np.where(weight > 0, -np.log(draws(points.h, plan.seed, restart, number)) / weight, np.inf)
    best = np.argsort(key, kind="stable")[:take]
    best = best[np.isfinite(key[best])]
    return key[best], points.z[best]


def candidate_weights(points: Points, candidates: np.ndarray) -> np.ndarray:
    return np.bincount(nearest(points.z, candidates)[0], weights=points.w, minlength=len(candidates))


def reduced(candidates: np.ndarray, weight: np.ndarray, k_lo: int, k_hi: int, plan: Plan, restart: int) -> dict[int, np.ndarray]:
    """Seeds of every k from weighted candidates: k-means++ among them, then Lloyd's rounds on them."""
    r = np.random.default_rng([plan.seed, restart])
    chosen = [int(r.choice(len(candidates), p=weight / weight.sum()))]
    d2 = squared_distances(candidates, candidates[chosen])[:, 0]
    while len(chosen) < k_hi and (weight * d2).sum() > 0:
        # Of a few draws the one that lowers the cost most.
        trials = r.choice(len(candidates), size=2 + int(np.log(k_hi)), p=weight * d2 / (weight * d2).sum())
        costs = np.minimum(d2[:, None], squared_distances(candidates, candidates[trials]))
        best = (weight[:, None] * costs).sum(axis=0).argmin()
        chosen.append(int(trials[best]))
        d2 = costs[:, best]
    few = Points(candidates, weight, np.zeros(len(candidates), dtype=np.int64))
    return {k: lloyd(few, candidates[chosen[:k]], 50, 0.0)[0] for k in range(k_lo, min(k_hi, len(chosen)) + 1)}


@dataclass
class Carried:
    """Label and bounds of each point under one model; distances counts what was computed."""

    label: np.ndarray
    upper: np.ndarray
    lower: np.ndarray
    distances: int = 0

    @staticmethod
    def begin(points: Points, centres: np.ndarray) -> Carried:
        far = np.sqrt(squared_distances(points.z, centres))
        label = far.argmin(axis=1)
        rows = np.arange(len(far))
        upper = far[rows, label]
        far[rows, label] = np.inf
        return Carried(label, upper, far.min(axis=1), far.size)

    def move(self, points: Points, before: np.ndarray, centres: np.ndarray) -> None:
        """Labels under moved centres: a full search only where the bounds leave a choice."""
        k = len(centres)
        shift = np.sqrt(((centres - before) ** 2).sum(axis=1))
        order = np.argsort(shift)
        others = np.full(k, shift[order[-1]])
        others[order[-1]] = shift[order[-2]] if k > 1 else 0.0
        self.upper += shift[self.label]
        self.lower -= others[self.label]
        apart = np.sqrt(squared_distances(centres, centres))
        np.fill_diagonal(apart, np.inf)
        safe = np.maximum(self.lower, apart.min(axis=1)[self.label] / 2)
        room = _ROOM * (1 + np.abs(self.upper))
        open_ = np.flatnonzero(self.upper >= safe - room)
        diff = points.z[open_] - centres[self.label[open_]]
        self.upper[open_] = np.sqrt((diff * diff).sum(axis=1))
        self.distances += len(open_) + k * k
        open_ = open_[self.upper[open_] >= safe[open_] - room[open_]]
        if len(open_):
            fresh = Carried.begin(Points(points.z[open_], points.w[open_], points.h[open_]), centres)
            self.label[open_], self.upper[open_], self.lower[open_] = fresh.label, fresh.upper, fresh.lower
            self.distances += fresh.distances


def sums(points: Points, label: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Weight and weighted vector sum of each label."""
    n = np.bincount(label, weights=points.w, minlength=k)
    total = np.stack([np.bincount(label, weights=points.w * points.z[:, j], minlength=k) for j in range(points.z.shape[1])], axis=1)
    return n, total


def means(n: np.ndarray, total: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Rounded, so that the order in which partial sums arrive does not show; an empty cluster keeps its centre."""
    return np.where(n[:, None] > 0, np.round(total / np.maximum(n, 1e-300)[:, None], 12), centres)


def lloyd(points: Points, centres: np.ndarray, max_iter: int, tol: float) -> tuple[np.ndarray, int, Carried | None]:
    """Centres, rounds made and the last state; ends when the squared shifts of all centres sum up to tol at most.

    The centres returned are those that the last round moved so little: the moved ones might make a larger step again.
    """
    state = None
    for iteration in range(1, max_iter + 1):
        if state is None:
            state = Carried.begin(points, centres)
        else:
            state.move(points, before, centres)  # noqa: F821 - set in the round before
        before, centres = centres, means(*sums(points, state.label, len(centres)), centres)
        if ((centres - before) ** 2).sum() <= tol:
            return before, iteration, state
    return centres, max_iter, state


def tolerance(points: Points, tol: float) -> float:
    """tol times the mean variance of the features."""
    weight = points.w / points.w.sum()
    mean = weight @ points.z
    return tol * float((weight @ (points.z - mean) ** 2).mean())


def fit_chunk(points: Points, k_lo: int, k_hi: int, plan: Plan, tol: float) -> Iterator[tuple[int, int, np.ndarray, float, int]]:
    """K, RESTART, CENTERS, INERTIA, ITERATIONS of every model of a segment that is one chunk."""
    limit = tolerance(points, tol)
    for restart in range(1, plan.restarts + 1):
        candidates = race(points, np.empty((0, points.z.shape[1])), 1, plan, restart, 0)[1]
        for number in range(1, plan.passes + 1):
            candidates = np.concatenate([candidates, race(points, candidates, plan.oversample, plan, restart, number)[1]])
        for k, seeds in reduced(candidates, candidate_weights(points, candidates), k_lo, k_hi, plan, restart).items():
            centres, iterations, _ = lloyd(points, seeds, plan.max_iter, limit)
            yield k, restart, centres, float((points.w * nearest(points.z, centres)[1]).sum()), iterations


def packed(points: DataFrame, chunk_rows: int) -> DataFrame:
    """SEGMENT_KEY, CHUNK, N (weight of the segment), CHUNKS (of the segment), ITEMS from weighted points."""
    sizes = stage(points.groupBy("SEGMENT_KEY").agg(
        F.sum("W").alias("N"), F.ceil(F.count(F.lit(1)) / chunk_rows).alias("CHUNKS")), "segment-chunks")
    item = F.struct(F.xxhash64("POINT_ID", "Z").alias("H"), "Z", "W")
    return points.join(with_size_check(sizes), "SEGMENT_KEY").groupBy(
        "SEGMENT_KEY", F.pmod(F.xxhash64("Z"), F.col("CHUNKS")).alias("CHUNK"), "N", "CHUNKS").agg(
        F.array_sort(F.collect_list(item)).alias("ITEMS"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1)


def _vectors(z: np.ndarray) -> pa.Array:
    """A list column with a vector a row."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]), pa.array(np.ascontiguousarray(z).ravel()))


def _nested(column: pa.Array) -> np.ndarray:
    """A column with one list of vectors."""
    rows = column.flatten()
    return rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1) if len(rows) else np.empty((0, 0))


_FITTED = "SEGMENT_KEY string, K int, RESTART int, CENTERS array<array<double>>, INERTIA double, ITERATIONS int"


def fit_small(chunks: DataFrame, candidates: DataFrame, segments: int, plan: Plan, tol: float) -> DataFrame:
    """All models of `segments` segments that are one chunk each. candidates: SEGMENT_KEY, K_LO, K_HI."""

    def work(batches):
        for row in _rows(batches):
            found = list(fit_chunk(Points.of(row.column("ITEMS")), row.column("K_LO")[0].as_py(), row.column("K_HI")[0].as_py(), plan, tol))
            if found:
                k, restart, centres, inertia, iterations = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [row.column("SEGMENT_KEY").take(pa.array([0] * len(k))), pa.array(k, pa.int32()), pa.array(restart, pa.int32()),
                     pa.array([c.tolist() for c in centres], _CENTERS), pa.array(inertia), pa.array(iterations, pa.int32())],
                    ["SEGMENT_KEY", "K", "RESTART", "CENTERS", "INERTIA", "ITERATIONS"])

    own = chunks.join(with_size_check(candidates.select("SEGMENT_KEY", "K_LO", "K_HI")), "SEGMENT_KEY")
    # A segment can be work for seconds: a number that is given keeps small partitions from being merged into one task.
    parts = max(2 * chunks.sparkSession.sparkContext.defaultParallelism, segments // 32)
    return own.select("SEGMENT_KEY", "ITEMS", "K_LO", "K_HI").repartition(parts, "SEGMENT_KEY").mapInArrow(work, _FITTED)


def seed_large(chunks: DataFrame, candidates: DataFrame, plan: Plan, dims: int) -> DataFrame:
    """MODEL and CENTERS for segments of several chunks, by passes over all chunks."""
    vectors = "array<array<double>>"
    keys = candidates.select("SEGMENT_KEY", "K_LO", "K_HI")
    own = chunks.select("SEGMENT_KEY", "ITEMS").join(with_size_check(keys.select("SEGMENT_KEY")), "SEGMENT_KEY")
    drawn = keys.select("SEGMENT_KEY", F.array().cast(f"array<{vectors}>").alias("DRAWN"))

    def pass_over(number: int, take: int):
        def work(batches):
            for row in _rows(batches):
                points, sets = Points.of(row.column("ITEMS")), row.column("DRAWN").flatten()
                for restart in range(1, plan.restarts + 1):
                    known = _nested(sets.slice(restart - 1, 1)) if len(sets) else np.empty((0, dims))
                    key, z = race(points, known, take, plan, restart, number)
                    yield pa.RecordBatch.from_arrays(
                        [row.column("SEGMENT_KEY").take(pa.array([0] * len(key), pa.int64())), pa.array([restart] * len(key), pa.int32()),
                         pa.array(key), _vectors(z)], ["SEGMENT_KEY", "RESTART", "DRAW", "Z"])
        return work

    for number in range(plan.passes + 1):
        take = plan.oversample if number else 1
        winners = own.join(with_size_check(drawn), "SEGMENT_KEY").mapInArrow(
            pass_over(number, take), "SEGMENT_KEY string, RESTART int, DRAW double, Z array<double>")
        # The smallest keys of all chunks: `take` per chunk come in.
        best = winners.groupBy("SEGMENT_KEY", "RESTART").agg(
            F.transform(F.slice(F.array_sort(F.collect_list(F.struct("DRAW", "Z"))), 1, take), lambda s: s["Z"]).alias("NEW"))
        per_segment = best.groupBy("SEGMENT_KEY").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("RESTART", "NEW"))), lambda s: s["NEW"]).alias("NEW"))
        drawn = stage(drawn.join(per_segment, "SEGMENT_KEY", "left").select(
            "SEGMENT_KEY", F.when(F.size("DRAWN") == 0, F.col("NEW")).when(F.col("NEW").isNull(), F.col("DRAWN")).otherwise(
                F.zip_with("DRAWN", "NEW", lambda a, b: F.concat(a, F.coalesce(b, F.array().cast(vectors))))).alias("DRAWN")), "candidates")

    def weigh(batches):
        for row in _rows(batches):
            points, sets = Points.of(row.column("ITEMS")), row.column("DRAWN").flatten()
            for restart in range(1, len(sets) + 1):
                weight = candidate_weights(points, _nested(sets.slice(restart - 1, 1)))
                met = np.flatnonzero(weight)
                yield pa.RecordBatch.from_arrays(
                    [row.column("SEGMENT_KEY").take(pa.array([0] * len(met), pa.int64())), pa.array([restart] * len(met), pa.int32()),
                     pa.array(met.astype(np.int32)), pa.array(weight[met])], ["SEGMENT_KEY", "RESTART", "AT", "WEIGHT"])

    weights = own.join(with_size_check(drawn), "SEGMENT_KEY").mapInArrow(
        weigh, "SEGMENT_KEY string, RESTART int, AT int, WEIGHT double").groupBy("SEGMENT_KEY", "RESTART", "AT").agg(
        F.round(F.sum("WEIGHT"), 9).alias("WEIGHT")).groupBy("SEGMENT_KEY", "RESTART").agg(
        F.array_sort(F.collect_list(F.struct("AT", "WEIGHT"))).alias("WEIGHTS"))

    def reduce(batches):
        for row in _rows(batches):
            restart = row.column("RESTART")[0].as_py()
            candidates_, marks = _nested(row.column("SET")), row.column("WEIGHTS").flatten()
            weight = np.zeros(len(candidates_))
            weight[marks.field("AT").to_numpy()] = marks.field("WEIGHT").to_numpy()
            seeds = reduced(candidates_, weight, row.column("K_LO")[0].as_py(), row.column("K_HI")[0].as_py(), plan, restart)
            yield pa.RecordBatch.from_arrays(
                [row.column("SEGMENT_KEY").take(pa.array([0] * len(seeds), pa.int64())), pa.array(list(seeds), pa.int32()),
                 pa.array([restart] * len(seeds), pa.int32()), pa.array([c.tolist() for c in seeds.values()], _CENTERS)],
                [*MODEL, "CENTERS"])

    sets = drawn.select("SEGMENT_KEY", F.posexplode("DRAWN").alias("AT", "SET")).withColumn("RESTART", F.col("AT") + 1).drop("AT")
    return sets.join(weights, ["SEGMENT_KEY", "RESTART"]).join(keys, "SEGMENT_KEY").select(
        "SEGMENT_KEY", "RESTART", "SET", "WEIGHTS", "K_LO", "K_HI").mapInArrow(
        reduce, f"SEGMENT_KEY string, K int, RESTART int, CENTERS {vectors}")


def _packed_models(models: DataFrame) -> DataFrame:
    """SEGMENT_KEY, MODELS: all models of a segment in one row."""
    fields = [c for c in ("K", "RESTART", "CENTERS", "BEFORE") if c in models.columns]
    return models.groupBy("SEGMENT_KEY").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("MODELS"))


_SUMS = "SEGMENT_KEY string, K int, RESTART int, LABEL int, N double, TOTAL array<double>"


def _sums_batch(key: pa.Array, rows: list) -> pa.RecordBatch:
    k, restart, label, n, total = zip(*rows, strict=True) if rows else ([],) * 5
    return pa.RecordBatch.from_arrays(
        [key.take(pa.array([0] * len(k), pa.int64())), pa.array(k, pa.int32()), pa.array(restart, pa.int32()), pa.array(label, pa.int32()),
         pa.array(n, pa.float64()), pa.array(total, pa.list_(pa.float64()))], [*MODEL, "LABEL", "N", "TOTAL"])


def chunk_sums(chunks: DataFrame, models: DataFrame) -> DataFrame:
    """MODEL, LABEL, N, TOTAL (weighted vector sum) of every chunk."""

    def work(batches):
        for row in _rows(batches):
            points, out = Points.of(row.column("ITEMS")), []
            for m in row.column("MODELS")[0].as_py():
                centres = np.array(m["CENTERS"])
                n, total = sums(points, nearest(points.z, centres)[0], len(centres))
                out += [(m["K"], m["RESTART"], j, n[j], total[j]) for j in np.flatnonzero(n).tolist()]
            yield _sums_batch(row.column("SEGMENT_KEY"), out)

    return chunks.select("SEGMENT_KEY", "ITEMS").join(
        with_size_check(stage(_packed_models(models), "segment-models")), "SEGMENT_KEY").mapInArrow(work, _SUMS)


_STATE = "array<struct<K:int, RESTART:int, LABEL:array<int>, UPPER:array<double>, LOWER:array<double>>>"


def carried_sums(state: DataFrame, models: DataFrame) -> DataFrame:
    """As chunk_sums, beside the rows of `state` (SEGMENT_KEY, CHUNK, ITEMS, STATE) brought up to date: STATE is null in
    rows of sums. models with BEFORE (centres of the round before). DISTANCES counts what was computed."""
    kind = pa.list_(pa.struct([
        ("K", pa.int32()), ("RESTART", pa.int32()), ("LABEL", pa.list_(pa.int32())), ("UPPER", pa.list_(pa.float64())),
        ("LOWER", pa.list_(pa.float64()))]))
    schema = f"SEGMENT_KEY string, CHUNK long, ITEMS {state.schema['ITEMS'].dataType.simpleString()}, STATE {_STATE}, DISTANCES long, SUMS array<struct<K:int, RESTART:int, LABEL:int, N:double, TOTAL:array<double>>>"

    def work(batches):
        for row in _rows(batches):
            points = Points.of(row.column("ITEMS"))
            known = row.column("STATE").flatten()
            at = {(k, r): i for i, (k, r) in enumerate(zip(known.field("K").to_pylist(), known.field("RESTART").to_pylist(), strict=True))}
            kept, out, distances = [], [], 0
            for m in row.column("MODELS")[0].as_py():
                centres, k, restart = np.array(m["CENTERS"]), m["K"], m["RESTART"]
                if (i := at.get((k, restart))) is None:
                    one = Carried.begin(points, centres)
                else:
                    one = Carried(*[known.field(c)[i].values.to_numpy().astype(t) for c, t in (
                        ("LABEL", np.int64), ("UPPER", np.float64), ("LOWER", np.float64))])
                    one.move(points, np.array(m["BEFORE"]), centres)
                distances += one.distances
                n, total = sums(points, one.label, k)
                out += [{"K": k, "RESTART": restart, "LABEL": j, "N": n[j], "TOTAL": total[j].tolist()} for j in np.flatnonzero(n).tolist()]
                kept.append({"K": k, "RESTART": restart, "LABEL": one.label, "UPPER": one.upper, "LOWER": one.lower})
            yield pa.RecordBatch.from_arrays(
                [row.column("SEGMENT_KEY"), row.column("CHUNK"), row.column("ITEMS"), pa.array([kept], kind), pa.array([distances]),
                 pa.array([out], pa.list_(pa.struct([
                     ("K", pa.int32()), ("RESTART", pa.int32()), ("LABEL", pa.int32()), ("N", pa.float64()), ("TOTAL", pa.list_(pa.float64()))])))],
                ["SEGMENT_KEY", "CHUNK", "ITEMS", "STATE", "DISTANCES", "SUMS"])

    return state.select("SEGMENT_KEY", "CHUNK", "ITEMS", "STATE").join(
        with_size_check(stage(_packed_models(models), "segment-models")), "SEGMENT_KEY").mapInArrow(work, schema)


def merged_means(parts: DataFrame, dims: int) -> DataFrame:
    """MODEL, MEANS (label -> mean): the sums of all chunks."""
    total = parts.groupBy(*MODEL, "LABEL").agg(F.sum("N").alias("N"), *[F.sum(F.col("TOTAL")[j]).alias(f"__t{j}") for j in range(dims)])
    mean = F.array(*[F.round(F.col(f"__t{j}") / F.col("N"), 12) for j in range(dims)])
    return total.groupBy(*MODEL).agg(F.map_from_entries(F.collect_list(F.struct("LABEL", mean.alias("MEAN")))).alias("MEANS"))


def moved(models: DataFrame, new_means: DataFrame, dims: int) -> DataFrame:
    """models with CENTERS replaced by the means, BEFORE and SHIFT (sum of the squared shifts)."""
    shift = " + ".join(f"(p[{j}] - q[{j}]) * (p[{j}] - q[{j}])" for j in range(dims))
    return models.drop("BEFORE", "SHIFT").join(new_means, MODEL).withColumnsRenamed({"CENTERS": "BEFORE"}).withColumn(
        "CENTERS", F.expr("transform(BEFORE, (ctr, pos) -> coalesce(MEANS[cast(pos as int)], ctr))")).withColumn(
        "SHIFT", F.expr(f"aggregate(zip_with(CENTERS, BEFORE, (p, q) -> {shift}), 0D, (a, x) -> a + x)")).drop("MEANS")


def inertias(chunks: DataFrame, models: DataFrame) -> DataFrame:
    """MODEL, INERTIA over all chunks."""

    def work(batches):
        for row in _rows(batches):
            points, out = Points.of(row.column("ITEMS")), []
            for m in row.column("MODELS")[0].as_py():
                d2 = nearest(points.z, np.array(m["CENTERS"]))[1]
                out.append((m["K"], m["RESTART"], 0, float((points.w * d2).sum()), []))
            yield _sums_batch(row.column("SEGMENT_KEY"), out)

    return chunks.select("SEGMENT_KEY", "ITEMS").join(
        with_size_check(stage(_packed_models(models), "segment-models")), "SEGMENT_KEY").mapInArrow(work, _SUMS).groupBy(*MODEL).agg(
        F.sum("N").alias("INERTIA"))


def _poisson(rate: np.ndarray, u: np.ndarray) -> np.ndarray:
    """A Poisson number of each rate from one uniform number; the rate itself where it is large."""
    times = np.zeros(len(rate), dtype=np.int64)
    chance = np.exp(-np.minimum(rate, 500))
    upto = chance.copy()
    # Up to the rate a chance may be tiny (e**-rate at 0); only beyond it that means the end.
    while (more := (u >= upto) & ((chance > 1e-18) | (times < rate)) & (rate <= 500)).any():
        times += more
        chance = np.where(more, chance * rate / np.maximum(times, 1), chance)
        upto = np.where(more, upto + chance, upto)
    return np.where(rate > 500, np.round(rate).astype(np.int64), times)


def mini_batches(chunks: DataFrame, batch_size: int, plan: Plan) -> DataFrame:
    """SEGMENT_KEY, BATCH, H, Z, TIMES: about batch_size rows of a segment (all it has, if fewer) for each of max_iter
    batches, drawn with replacement; TIMES says how often a point was drawn."""

    def work(batches):
        for row in _rows(batches):
            points, n = Points.of(row.column("ITEMS")), row.column("N")[0].as_py()
            rate = plan.max_iter * min(batch_size, n) * points.w / n
            times = _poisson(rate, draws(points.h, plan.seed, -1))
            at = np.repeat(np.arange(len(times)), times)
            nth = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
            batch = (draws(points.h[at], plan.seed, -2, nth) * plan.max_iter).astype(np.int64)
            drawn, times = np.unique(at * plan.max_iter + batch, return_counts=True)
            at, batch = drawn // plan.max_iter, drawn % plan.max_iter
            yield pa.RecordBatch.from_arrays(
                [row.column("SEGMENT_KEY").take(pa.array(np.zeros(len(at), dtype=np.int64))), pa.array(batch),
                 pa.array(points.h[at]), _vectors(points.z[at]), pa.array(times.astype(np.float64))],
                ["SEGMENT_KEY", "BATCH", "H", "Z", "TIMES"])

    return chunks.select("SEGMENT_KEY", "N", "ITEMS").mapInArrow(
        work, "SEGMENT_KEY string, BATCH long, H long, Z array<double>, TIMES double")


@dataclass
class Running:
    """Centres of all models of one k while mini-batches pass; seen: points each centre has taken so far."""

    k: int
    restarts: list[int]
    centres: np.ndarray  # restart x k x dims
    seen: np.ndarray = field(init=False)

    def __post_init__(self):
        self.seen = np.zeros(self.centres.shape[:2])

    @staticmethod
    def of(models: list[dict]) -> list[Running]:
        by_k: dict[int, list[dict]] = {}
        for m in models:
            by_k.setdefault(m["K"], []).append(m)
        return [Running(k, [m["RESTART"] for m in own], np.array([m["CENTERS"] for m in own])) for k, own in by_k.items()]

    def take(self, z: np.ndarray, times: np.ndarray) -> None:
        runs, k, dims = self.centres.shape
        at = (closest(z, self.centres)[0] + k * np.arange(runs)[:, None]).ravel()
        n = np.bincount(at, weights=np.tile(times, runs), minlength=runs * k).reshape(runs, k)
        total = np.stack([np.bincount(at, weights=np.tile(times * z[:, j], runs), minlength=runs * k).reshape(runs, k) for j in range(dims)], axis=2)
        self.seen += n
        self.centres += (total - n[..., None] * self.centres) / np.maximum(self.seen, 1)[..., None]


def fit_mini_batch(chunks: DataFrame, seeds: DataFrame, batch_size: int, plan: Plan) -> DataFrame:
    """MODEL, CENTERS, ITERATIONS: every batch of a segment moves all its models; a segment is one task, which holds one
    batch at a time and meets max_iter batches whatever the segment's size."""
    # Models come as flat rows before the batches: a nested column, null in every drawn row, would cost most of the time.
    models = seeds.select(
        "SEGMENT_KEY", F.lit(-1).cast("long").alias("BATCH"), (F.col("K") * F.lit(1 << 32) + F.col("RESTART")).alias("H"),
        F.flatten("CENTERS").alias("Z"), F.lit(None).cast("double").alias("TIMES"), "K", "RESTART")
    drawn = mini_batches(chunks, batch_size, plan).withColumns({c: F.lit(None).cast("int") for c in ("K", "RESTART")})
    parts = 2 * chunks.sparkSession.sparkContext.defaultParallelism  # given, so that light partitions are not merged
    streams = models.unionByName(drawn).repartition(parts, "SEGMENT_KEY").sortWithinPartitions("SEGMENT_KEY", "BATCH", "H")

    def work(batches):
        key, given, running, waiting, of = None, [], [], [], None

        def flush():
            if waiting and running:
                z, times = (np.concatenate(x) for x in zip(*waiting, strict=True))
                for models_of_k in running:
                    models_of_k.take(z, times)
            waiting.clear()

        def result():
            flush()
            found = [(m.k, restart, np.round(c, 12).tolist()) for m in running for restart, c in zip(m.restarts, m.centres, strict=True)]
            k, restart, centres = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array([key] * len(k)), pa.array(k, pa.int32()), pa.array(restart, pa.int32()), pa.array(centres, _CENTERS)],
                [*MODEL, "CENTERS"])

        for batch in batches:
            if not batch.num_rows:
                continue
            codes = batch.column("SEGMENT_KEY").dictionary_encode().indices.to_numpy()
            number = batch.column("BATCH").to_numpy()
            cuts = np.flatnonzero((codes[1:] != codes[:-1]) | (number[1:] != number[:-1])) + 1
            for a, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                part = batch.slice(a, end - a)
                now = part.column("SEGMENT_KEY")[0].as_py(), int(number[a])
                if now[0] != key:
                    if running:
                        yield result()
                    key, given, running = now[0], [], []
                    waiting.clear()
                elif now != of:
                    flush()
                of = now
                if now[1] < 0:
                    given += [
                        {"K": m["K"], "RESTART": m["RESTART"], "CENTERS": np.array(m["Z"]).reshape(m["K"], -1)}
                        for m in part.select(["K", "RESTART", "Z"]).to_pylist()]
                    running = Running.of(given)
                else:
                    z = part.column("Z").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                    waiting.append((z, part.column("TIMES").to_numpy(zero_copy_only=False)))
        if running:
            yield result()

    return streams.mapInArrow(work, "SEGMENT_KEY string, K int, RESTART int, CENTERS array<array<double>>").withColumn(
        "ITERATIONS", F.lit(plan.max_iter))
