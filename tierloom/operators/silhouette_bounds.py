"""Certified bounds of the mean silhouette with less than quadratic work.

About root-n points of a segment serve as pivots; every point joins the cell of its nearest pivot. Of the points of a cell
that share their labels the number n, the mean m and the mean squared distance v from it are kept. For a point at distance
d from m the sum of its distances to them lies between n * d (the distance is convex) and n * sqrt(d^2 + v) (no sum of
roots exceeds that of equal terms), a gap that vanishes with v / d^2. Only cells for which that ratio may be above
`openness`^2 are opened, which means that their points are sent to the asking cell and measured one by one. With an
openness of 0 all cells with different points are opened, and both bounds are the exact value.

Cells and pivots grow as the root of a segment, so the work of an n-point segment grows as n * root n; a task holds one
cell and the summaries of its segment, and large cells are cut into parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.functions.sampling import uniform
from tierloom.operators.silhouette import distances
from tierloom.sources.staging import stage, with_size_check

_ITEM = "struct<Z:array<double>, W:double, LABELS:array<int>>"
# Floating-point error of the sums, far above what can arise and far below what matters.
_SLACK = 1e-9


def silhouette_bounds(
    labelled: DataFrame, openness: float = 0.25, cell_rows: int = 4096, chunk_rows: int = 4096, pivots: float = 1.0,
) -> DataFrame:
    """SEGMENT_KEY, K, LOWER, UPPER, POINTS, OPENED_PAIRS from rows SEGMENT_KEY, Z, W, KS, LABELS (Z distinct per segment).

    The silhouette lies within LOWER and UPPER. OPENED_PAIRS: distances that were measured point by point; POINTS: distinct
    points. As for the exact measure, a k with a single label present scores -1 and a point alone in its cluster 0.
    """
    points = labelled.select("SEGMENT_KEY", "Z", F.col("W").cast("double").alias("W"), "KS", "LABELS")
    cells = _cells(points, cell_rows, chunk_rows, pivots)
    context = stage(_context(cells).join(points.groupBy("SEGMENT_KEY").agg(F.first("KS").alias("KS")), "SEGMENT_KEY"), "silhouette-context")
    asked = stage(_bounded(cells, context, openness), "silhouette-bounded")
    sent = asked.select("SEGMENT_KEY", F.col("CELL").alias("ASKS"), F.explode("OPEN").alias("CELL")).join(
        cells.select("SEGMENT_KEY", "CELL", "ITEMS"), ["SEGMENT_KEY", "CELL"])
    columns = ["SEGMENT_KEY", "ASKS", "ROLE", "ITEMS", "KS", "COUNTS", "LOW", "HIGH"]
    own = asked.withColumns({"ASKS": F.col("CELL"), "ROLE": F.lit(0)}).select(columns)
    none = {c: F.lit(None).cast(own.schema[c].dataType) for c in ("KS", "COUNTS", "LOW", "HIGH")}
    streams = own.unionByName(sent.withColumns({"ROLE": F.lit(1), **none}).select(columns)).repartition(
        "SEGMENT_KEY", "ASKS").sortWithinPartitions("SEGMENT_KEY", "ASKS", "ROLE")
    parts = streams.mapInArrow(
        _opened, "SEGMENT_KEY string, K int, LOW double, HIGH double, WEIGHT double, POINTS long, PAIRS long")
    total = F.sum("WEIGHT")
    return parts.groupBy("SEGMENT_KEY", "K").agg(
        F.when(F.max("LOW").isNull(), -1.0).otherwise(F.greatest(F.sum("LOW") / total - _SLACK, F.lit(-1.0))).alias("LOWER"),
        F.when(F.max("HIGH").isNull(), -1.0).otherwise(F.least(F.sum("HIGH") / total + _SLACK, F.lit(1.0))).alias("UPPER"),
        F.sum("POINTS").alias("POINTS"), F.sum("PAIRS").alias("OPENED_PAIRS"))


def _cells(points: DataFrame, cell_rows: int, chunk_rows: int, pivots: float) -> DataFrame:
    """SEGMENT_KEY, CELL, ITEMS, PARTS (n, mean, v and labels of the points of equal labels)."""
    sizes = stage(points.groupBy("SEGMENT_KEY").agg(F.count(F.lit(1)).alias("N")), "silhouette-sizes")
    sized = points.join(with_size_check(sizes), "SEGMENT_KEY")
    draw = uniform(F.lit("pivot"), F.col("Z"))
    chosen = sized.groupBy("SEGMENT_KEY").agg(
        F.collect_list(F.when(draw < pivots / F.sqrt("N"), F.col("Z"))).alias("PIVOTS"), F.min_by("Z", draw).alias("ONE")).select(
        "SEGMENT_KEY", F.when(F.size("PIVOTS") > 0, F.col("PIVOTS")).otherwise(F.array("ONE")).alias("PIVOTS"))
    item = F.struct("Z", "W", "LABELS")
    chunks = sized.groupBy(
        "SEGMENT_KEY", F.pmod(F.xxhash64("Z"), F.ceil(F.col("N") / chunk_rows)).alias("CHUNK")).agg(F.collect_list(item).alias("ITEMS"))
    placed = stage(
        chunks.join(with_size_check(stage(chosen, "silhouette-pivots")), "SEGMENT_KEY").select("SEGMENT_KEY", "ITEMS", "PIVOTS").mapInArrow(
            _place, f"SEGMENT_KEY string, PIVOT long, PART long, ITEM {_ITEM}"), "silhouette-placed")
    crowds = placed.groupBy("SEGMENT_KEY", "PIVOT").agg(F.ceil(F.count(F.lit(1)) / cell_rows).alias("CUTS"))
    cell = F.col("PIVOT") * (1 << 20) + F.pmod(F.col("PART"), F.col("CUTS"))
    packed = placed.join(with_size_check(stage(crowds, "silhouette-crowds")), ["SEGMENT_KEY", "PIVOT"]).groupBy(
        "SEGMENT_KEY", cell.alias("CELL")).agg(F.collect_list("ITEM").alias("ITEMS"))
    return stage(packed.mapInArrow(
        _summarise, f"SEGMENT_KEY string, CELL long, ITEMS array<{_ITEM}>,"
        " PARTS array<struct<N:double, MEAN:array<double>, V:double, LABELS:array<int>>>"), "silhouette-cells")


def _context(cells: DataFrame) -> DataFrame:
    """SEGMENT_KEY, ALL: the summaries of all cells of the segment, in a fixed order."""
    return cells.select("SEGMENT_KEY", "CELL", F.explode("PARTS").alias("P")).groupBy("SEGMENT_KEY").agg(
        F.array_sort(F.collect_list(F.struct("CELL", "P.N", "P.MEAN", "P.V", "P.LABELS"))).alias("ALL"))


def _bounded(cells: DataFrame, context: DataFrame, openness: float) -> DataFrame:
    """cells with OPEN (cells to open), COUNTS (weight per slot), LOW and HIGH (per point and slot, closed cells only)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            z, _, _ = _items(row.column("ITEMS"))
            every = row.column("ALL").flatten()
            mean, v = _matrix(every.field("MEAN")), every.field("V").to_numpy(zero_copy_only=False)
            ks = row.column("KS").flatten().to_numpy()
            marks = _marks(_matrix(every.field("LABELS")), every.field("N").to_numpy(zero_copy_only=False), ks)
            middle = z.mean(axis=0)
            gap = np.maximum(distances(middle[None], mean)[0] - distances(middle[None], z).max(), 0)
            names, of = np.unique(every.field("CELL").to_numpy(), return_inverse=True)
            wide = np.zeros(len(names), dtype=bool)
            np.logical_or.at(wide, of, v > (openness * gap) ** 2)
            closed = ~wide[of]
            low = np.zeros((len(z), marks.shape[1]))
            high = low.copy()
            for i in range(0, len(z), 512):
                d = distances(z[i:i + 512], mean[closed])
                low[i:i + 512] = d @ marks[closed]
                high[i:i + 512] = np.sqrt(d * d + v[closed]) @ marks[closed]
            lists = [names[wide], marks.sum(axis=0), low.ravel(), high.ravel()]
            yield pa.RecordBatch.from_arrays(
                [row.column("SEGMENT_KEY"), row.column("CELL"), row.column("ITEMS"), row.column("KS"), *[
                    pa.array([x], pa.list_(pa.int64() if i == 0 else pa.float64())) for i, x in enumerate(lists)]],
                ["SEGMENT_KEY", "CELL", "ITEMS", "KS", "OPEN", "COUNTS", "LOW", "HIGH"])

    return cells.select("SEGMENT_KEY", "CELL", "ITEMS").join(with_size_check(context), "SEGMENT_KEY").select(
        "SEGMENT_KEY", "CELL", "ITEMS", "ALL", "KS").mapInArrow(
        work, f"SEGMENT_KEY string, CELL long, ITEMS array<{_ITEM}>, KS array<int>, OPEN array<long>, COUNTS array<double>,"
        " LOW array<double>, HIGH array<double>")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _items(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Z, W, LABELS of a column with one list of points."""
    flat = column.flatten()
    return _matrix(flat.field("Z")), flat.field("W").to_numpy(zero_copy_only=False), _matrix(flat.field("LABELS"))


def _marks(labels: np.ndarray, weight: np.ndarray, ks: np.ndarray) -> np.ndarray:
    """row x slot: the row's weight in the slot of its label, for each k; the slots of a k lie together."""
    starts = np.r_[0, np.cumsum(ks)[:-1]].astype(np.int64)
    marks = np.zeros((len(labels), int(ks.sum())))
    np.put_along_axis(marks, labels + starts[None], np.repeat(weight[:, None], len(ks), axis=1), axis=1)
    return marks


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        z, _, _ = _items(row.column("ITEMS"))
        pivots = _matrix(row.column("PIVOTS").flatten())
        own = np.concatenate([distances(z[i:i + 512], pivots).argmin(axis=1) for i in range(0, len(z), 512)])
        yield pa.RecordBatch.from_arrays(
            [row.column("SEGMENT_KEY").take(pa.array(np.zeros(len(z), dtype=np.int64))), pa.array(own), pa.array(np.arange(len(z))),
             row.column("ITEMS").flatten()], ["SEGMENT_KEY", "PIVOT", "PART", "ITEM"])


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        z, w, labels = _items(row.column("ITEMS"))
        names, of = np.unique(labels, axis=0, return_inverse=True)
        of = of.ravel()
        parts = []
        for i, name in enumerate(names):
            own, weight = z[of == i], w[of == i]
            mean = (weight[:, None] * own).sum(axis=0) / weight.sum()
            spread = float((weight * ((own - mean) ** 2).sum(axis=1)).sum() / weight.sum())
            if len(own) == 1:
                mean, spread = own[0], 0.0
            parts.append({"N": float(weight.sum()), "MEAN": mean.tolist(), "V": spread, "LABELS": name.tolist()})
        kind = pa.list_(pa.struct([
            ("N", pa.float64()), ("MEAN", pa.list_(pa.float64())), ("V", pa.float64()), ("LABELS", pa.list_(pa.int32()))]))
        yield pa.RecordBatch.from_arrays([*row.columns, pa.array([parts], kind)], ["SEGMENT_KEY", "CELL", "ITEMS", "PARTS"])


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the opened cells to the bounds of a cell's points, and sums up the bounds of their silhouettes."""
    own = None
    for row in _rows(batches):
        if row.column("ROLE")[0].as_py() == 0:
            if own is not None:
                yield _scored(own)
            z, w, labels = _items(row.column("ITEMS"))
            ks, counts = (row.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("KS", "COUNTS"))
            low, high = (_matrix(row.column(c)).reshape(len(z), -1).copy() for c in ("LOW", "HIGH"))
            own = row.column("SEGMENT_KEY"), z, w, labels, ks, counts, low, high, [0]
            continue
        z, w, labels = _items(row.column("ITEMS"))
        _, mine, _, _, ks, _, low, high, pairs = own
        marks = _marks(labels, w, ks)
        for i in range(0, len(mine), 512):
            sums = distances(mine[i:i + 512], z) @ marks
            low[i:i + 512] += sums
            high[i:i + 512] += sums
        pairs[0] += len(mine) * len(z)
    if own is not None:
        yield _scored(own)


def _scored(own) -> pa.RecordBatch:
    key, _, w, labels, ks, counts, low, high, pairs = own
    rows, out, start = np.arange(len(w)), [], 0
    for i, k in enumerate(ks):
        slots, mine = slice(start, start + k), labels[:, i]
        start += k
        n = counts[slots]
        if (n > 0).sum() < 2:
            out.append((int(k), None, None, float(w.sum())))
            continue
        sides = []
        with np.errstate(divide="ignore", invalid="ignore"):
            for sums in (low[:, slots], high[:, slots]):
                inner = sums[rows, mine] / (n[mine] - 1)
                means = np.where(n > 0, sums / n, np.inf)
                means[rows, mine] = np.inf
                sides.append((inner, means.min(axis=1)))
            (a_low, b_low), (a_high, b_high) = sides
            ends = [(b - a) / np.maximum(a, b) for a, b in ((a_high, b_low), (a_low, b_high))]
        alone = n[mine] <= 1
        s_low, s_high = (np.where(alone | ~np.isfinite(s), 0.0, s) for s in ends)
        out.append((int(k), float((s_low * w).sum()), float((s_high * w).sum()), float(w.sum())))
    k, s_low, s_high, weight = zip(*out, strict=True)
    n = len(out)
    return pa.RecordBatch.from_arrays(
        [key.take(pa.array([0] * n)), pa.array(k, pa.int32()), pa.array(s_low, pa.float64()), pa.array(s_high, pa.float64()), pa.array(weight),
         pa.array([len(w)] * n), pa.array([pairs[0]] * n)], ["SEGMENT_KEY", "K", "LOW", "HIGH", "WEIGHT", "POINTS", "PAIRS"])
