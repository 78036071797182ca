"""Embedding near-duplicates by an inverted multi-index over the halves of normalised vectors.

Two independent codebooks, one on each half, form a grid of cells; a vector lives in the cell of its nearest codewords. A
multi-sequence traversal visits the cells in the order of their distance, the sum over both halves, and goes on until the
distance exceeds that of the own cell by a margin. The margin is fitted so that partners exactly at the threshold, made
from sampled vectors, are met from one side or the other at `target_recall`; closer partners are met more often. Pairs met
are verified by their cosine in double precision, and each is counted in one cell: the smaller, if both sides meet.

Codebooks and margin are fitted on a bounded sample (`sample_rows`, or 32 rows a codeword if that is more: it grows with the root of the
table); every row is indexed and searched. Equal vectors are one weighted point, so exact copies cost nothing. Large cells are cut into
blocks, and each pair of blocks is a piece of work of its own that reports a count and a local component per row, never
pairs: memory is bounded, nothing is capped, and work grows with the square of a group only for different vectors that really lie
within the same cells.

Cases: rows with a null id, null vectors, zero vectors, those with null or non-finite components and those whose length
is not that of the most vectors (the smallest such length) link with nothing and come back with 0 links, their own id as
component (null if null) and kept = true; identical rows are one vector and come back once each; equal ids with different
vectors are different vectors; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.llm.components import connected_components
from tierloom.sources.staging import stage, with_size_check

BLOCK_ROWS = 1024
CHUNK_ROWS = 4096


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def codebook(points: np.ndarray, k: int, r: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """k centres by Lloyd's rounds; empty ones stay where they are."""
    centres = points[r.choice(len(points), k, replace=False)]
    for _ in range(rounds):
        own = ((centres ** 2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)
        size = np.bincount(own, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, own, points)
        centres = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centres)
    return centres


@dataclass
class MultiIndex:
    """Codebooks of both halves; cell (i, j) has number i * k + j."""

    halves: tuple[np.ndarray, np.ndarray]
    margin: float = 0.0

    @staticmethod
    def fit(sample: np.ndarray, k: int, threshold: float, target_recall: float, probes: int = 4000, seed: int = 5) -> MultiIndex:
        """sample: unit vectors."""
        r = np.random.default_rng(seed)
        middle = sample.shape[1] // 2
        index = MultiIndex((codebook(sample[:, :middle], k, r), codebook(sample[:, middle:], k, r)))
        x = sample[np.linspace(0, len(sample) - 1, min(probes, len(sample))).astype(np.int64)]
        aside = r.normal(size=x.shape)
        aside -= (aside * x).sum(axis=1, keepdims=True) * x
        length = np.linalg.norm(aside, axis=1, keepdims=True)
        y = threshold * x + math.sqrt(1 - threshold ** 2) * aside / np.where(length > 0, length, 1)
        met = np.minimum(index.detour(x, y), index.detour(y, x))
        index.margin = float(np.quantile(met, target_recall, method="higher"))
        return index

    @property
    def k(self) -> int:
        return len(self.halves[0])

    def distances(self, points: np.ndarray) -> list[np.ndarray]:
        """For each half, how much farther each codeword is (squared) than the nearest."""
        middle = self.halves[0].shape[1]
        out = []
        for part, book in zip((points[:, :middle], points[:, middle:]), self.halves, strict=True):
            far = (book ** 2).sum(axis=1) - 2 * part @ book.T
            out.append(far - far.min(axis=1, keepdims=True))
        return out

    def detour(self, points: np.ndarray, others: np.ndarray) -> np.ndarray:
        """How much farther each of `others` lives from its point than the point's own cell."""
        rows = np.arange(len(points))
        return sum(d[rows, o.argmin(axis=1)] for d, o in zip(self.distances(points), self.distances(others), strict=True))

    def visits(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells within the margin, nearest first, the own cell in front: flat numbers, and where each point's begin."""
        first, second = self.distances(points)
        order = [np.argsort(d, axis=1, kind="stable") for d in (first, second)]
        near = [np.take_along_axis(d, o, axis=1) for d, o in zip((first, second), order, strict=True)]
        width = int((near[0] <= self.margin).sum(axis=1).max())
        rows = np.arange(len(points))  # points still going on
        at = np.zeros((len(points), width), dtype=np.int64)  # the second codeword each first one has come to
        met_row, met_cell = [], []
        while len(rows):
            open_ = at < self.k
            open_[:, 1:] &= at[:, 1:] < at[:, :-1]
            far = near[0][rows, :width] + np.take_along_axis(near[1][rows], np.minimum(at, self.k - 1), axis=1)
            far = np.where(open_, far, np.inf)
            best = far.argmin(axis=1)
            n = np.arange(len(rows))
            goes_on = far[n, best] <= self.margin
            rows, at, best = rows[goes_on], at[goes_on], best[goes_on]
            n = n[:len(rows)]
            j = at[n, best]
            met_row.append(rows)
            met_cell.append(order[0][rows, best] * self.k + order[1][rows, j])
            at[n, best] += 1
        row, cell = np.concatenate(met_row), np.concatenate(met_cell)
        by_row = np.argsort(row, kind="stable")
        return cell[by_row], np.searchsorted(row[by_row], np.arange(len(points) + 1))


@dataclass
class Side:
    """Rows of a block: unit vectors, keys, weights; cells: numbers of the cells each has visited (a visitor: its home)."""

    key: np.ndarray
    weight: np.ndarray
    points: np.ndarray
    cells: np.ndarray
    cell_starts: np.ndarray


def links_between(left: Side, right: Side | None, cell: int, visitors: bool, threshold: float):
    """key, links (weight of the linked rows counted here) and root (smallest key of the local component) for each row
    with a link. left: rows that live in the cell. right: more of them, rows that visit it, or None: left with itself."""
    other = left if right is None else right
    linked = left.points @ other.points.T >= threshold
    if right is None:
        np.fill_diagonal(linked, False)
    row, col = np.nonzero(linked)
    if not len(row):
        return None
    counted = linked
    if visitors:
        # Both meet if the visitor's home is among the cells that the row living here visits.
        home = other.cells[other.cell_starts[:-1]]
        smaller = home[col] < cell
        visited = np.repeat(np.arange(len(left.key)), np.diff(left.cell_starts)) * (left.cells.max() + home.max() + 1) + left.cells
        twice = smaller & np.isin(row * (left.cells.max() + home.max() + 1) + home[col], visited)
        counted = linked.copy()
        counted[row[twice], col[twice]] = False
    count_left = counted @ other.weight
    root_left, root_right = left.key.copy(), other.key.copy()
    none = np.iinfo(np.int64).max
    while True:
        new_left = np.minimum(root_left, np.where(linked, root_right[None, :], none).min(axis=1))
        new_right = new_left if right is None else np.minimum(root_right, np.where(linked, new_left[:, None], none).min(axis=0))
        if (new_left == root_left).all() and (new_right == root_right).all():
            break
        root_left, root_right = new_left, new_right
    has = linked.any(axis=1)
    out = [(left.key[has], count_left[has], root_left[has])]
    if right is not None:
        has, count_right = linked.any(axis=0), left.weight @ counted
        out.append((other.key[has], count_right[has], root_right[has]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _digests() -> list[Column]:
    return [F.xxhash64(F.lit(salt), "v").alias(name) for salt, name in ((1, "h1"), (2, "h2"))]


def _classes(rows: DataFrame) -> DataFrame:
    """key, least (smallest id), weight (different ids), v, h1, h2 of each distinct vector of rows (id, v, h1, h2)."""
    parted = rows.groupBy("h1", "h2", "id").agg(F.first("v").alias("v"))
    merged = parted.groupBy("h1", "h2").agg(
        F.min("id").alias("least"), F.count("*").alias("weight"), F.first("v").alias("v"))
    return stage(merged.withColumn("key", F.monotonically_increasing_id()), "vector_classes")


def _placed(classes: DataFrame, index: MultiIndex, dims: int) -> DataFrame:
    """key, weight, v, cells (own cell first)."""
    sent = classes.sparkSession.sparkContext.broadcast(index)

    def work(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(at, CHUNK_ROWS)
                cells, starts = sent.value.visits(unit(_matrix(part.column(2), dims)))
                lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(cells))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=["key", "weight", "v", "cells"])

    return stage(classes.select("key", "weight", "v").mapInArrow(
        work, f"key long, weight long, v {classes.schema['v'].dataType.simpleString()}, cells array<long>"), "placed_vectors")


def _dealt(placed: DataFrame, block_rows: int) -> DataFrame:
    """Rows as (cell, i, t, side, key, weight, v, cells): side 0 is block i of the rows living in the cell, side 1 its
    partner t, another such block (t > i) or, from t = number of such blocks on, a block of visitors."""
    cell = placed.select(F.posexplode("cells").alias("nth", "cell"))
    sizes = with_size_check(stage(cell.groupBy("cell").agg(
        F.count(F.when(F.col("nth") == 0, 1)).alias("n_home"), F.count(F.when(F.col("nth") > 0, 1)).alias("n_guests")).select(
        "cell", *[F.ceil(F.col(n) / block_rows).cast("int").alias(b) for n, b in (("n_home", "h"), ("n_guests", "w"))]).where(
        "h > 0"), "cell_sizes"))
    salt = F.pmod(F.xxhash64("key"), F.lit(1 << 20)).cast("int")
    pair = "struct<i:int, t:int, side:int>"
    home = placed.withColumn("cell", F.col("cells")[0]).join(sizes, "cell").withColumn("b", salt % F.col("h")).withColumn(
        "to", F.expr(
            f"concat(transform(sequence(b, h + w - 1), t -> cast(struct(b, t, 0) as {pair})),"
            f" if(b = 0, cast(array() as array<{pair}>), transform(sequence(0, b - 1), i -> cast(struct(i, b, 1) as {pair}))))"))
    guests = placed.select("*", F.posexplode("cells").alias("nth", "cell")).where("nth > 0").drop("nth").withColumn(
        "cells", F.slice("cells", 1, 1)).join(sizes, "cell").withColumn("b", salt % F.col("w")).withColumn(
        "to", F.expr(f"transform(sequence(0, h - 1), i -> cast(struct(i, h + b, 1) as {pair}))"))
    columns = ["cell", F.explode("to").alias("to"), F.col("h"), "key", "weight", "v", "cells"]
    return home.select(columns).unionByName(guests.select(columns)).select(
        "cell", "to.i", "to.t", "to.side", (F.col("to.t") >= F.col("h")).alias("guests"), "key", "weight", "v", "cells")


def _verified(dealt: DataFrame, dims: int, threshold: float) -> DataFrame:
    """key, links, root for each row and piece of work in which it has a link."""

    def side(parts: list[pa.RecordBatch]) -> Side:
        table = pa.Table.from_batches(parts).combine_chunks()
        lists = table["cells"].combine_chunks()
        return Side(
            table["key"].to_numpy(), table["weight"].to_numpy(), unit(_matrix(table["v"].combine_chunks(), dims)),
            lists.flatten().to_numpy(), np.r_[0, np.cumsum(lists.value_lengths().to_numpy())])

    def piece(work: tuple[int, int, int], guests: bool, halves: tuple[list, list]):
        if not halves[0]:
            return None
        left = side(halves[0])
        right = side(halves[1]) if halves[1] else None
        if work[1] != work[2] and right is None:
            return None
        return links_between(left, right, work[0], guests, threshold)

    def work(batches):
        now, guests, halves, out, size = None, False, ([], []), [], 0

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["key", "links", "root"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([batch.column(i).to_numpy() for i in range(4)])
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, z in zip(cuts, cuts[1:], strict=False):
                if now != (of := tuple(keys[a, :3].tolist())):
                    if now is not None and (found := piece(now, guests, halves)):
                        out.append(found)
                        size += len(found[0])
                    now, guests, halves = of, batch.column(4)[a].as_py(), ([], [])
                halves[keys[a, 3]].append(batch.slice(a, z - a))
            if size > 20_000:
                yield flush()
                out, size = [], 0
        if now is not None and (found := piece(now, guests, halves)):
            out.append(found)
        if out:
            yield flush()

    return dealt.repartition("cell", "i", "t").sortWithinPartitions("cell", "i", "t", "side").mapInArrow(
        work, "key long, links long, root long")


def fit(classes: DataFrame, count: int, dims: int, threshold: float, cell_rows: int, sample_rows: int, target_recall: float) -> MultiIndex:
    k = max(1, round(math.sqrt(count / cell_rows)))
    sample_rows = max(sample_rows, 32 * k)
    sample = classes
    if count > sample_rows:
        sample = classes.where(F.pmod(F.xxhash64("h1", "h2"), F.lit(1 << 30)) < int(sample_rows / count * (1 << 30)))
    points = sample.select("h1", "h2", "v").orderBy("h1", "h2").toArrow()["v"].combine_chunks()
    points = unit(_matrix(points, dims))
    return MultiIndex.fit(points, max(1, min(k, len(points) // 8)), threshold, target_recall)


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.9, target_recall: float = 0.98, cell_rows: int = 200,
    sample_rows: int = 20_000, block_rows: int = BLOCK_ROWS, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors."""
    # Four-byte components stay as they are: every double made of them is exact, and half as much is shuffled.
    kept = F.col(f"`{vector_col}`")
    if not isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType):
        kept = kept.cast("array<double>")
    everyone = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), kept.alias("v"))
    sound = F.col("id").isNotNull() & F.col("v").isNotNull() & F.coalesce(
        ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    length = everyone.where(sound).groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    dims = length["d"] if length else 0
    takes_part = sound & (F.size("v") == dims)
    others = everyone.where(~takes_part).select(
        F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    if not dims:
        return others
    rows = stage(everyone.where(takes_part).select("id", "v", *_digests()), "sound_vectors")
    classes = _classes(rows)
    count = classes.count()
    if dims < 2:
        # Halves need two components; a zero beside the only one changes no cosine.
        classes, dims = classes.withColumn("v", F.concat("v", F.array(F.lit(0.0)).cast(classes.schema["v"].dataType))), 2
    index = fit(classes, count, dims, threshold, cell_rows, sample_rows, target_recall)
    found = stage(_verified(_dealt(_placed(classes, index, dims), block_rows), dims, threshold), "verified_links")
    linked = found.groupBy("key").agg(F.sum("links").alias("links"))
    roots = stage(connected_components(found.select(F.col("key").alias("u"), F.col("root").alias("v"))), "link_roots")
    least = roots.join(classes.select(F.col("key").alias("node"), "least"), "node").groupBy("root").agg(
        F.min("least").alias("component_id"))
    known = classes.select("key", "h1", "h2", "least", "weight").join(linked, "key", "left").join(
        roots.withColumnRenamed("node", "key").join(least, "root"), "key", "left").select(
        "h1", "h2", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "least").alias("component_id"))
    return rows.select(F.col("id").alias("vec_id"), "h1", "h2").join(known, ["h1", "h2"]).select(
        "vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")).unionByName(others)
