"""Numbers, running sums and the next row along one global order, without a window per group.

Rows are dealt by ranges of (group, order), so a group of any size spans many blocks; a block is summed up in its task,
and only two border rows a block reach the driver, where what earlier blocks hold of a group is carried on.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.sources.staging import stage

BLOCK_ROWS = 100_000


def blocks_for(rows: int, block_rows: int = BLOCK_ROWS) -> int:
    return max(1, -(-rows // block_rows))


def starts_of(columns: list[pa.Array]) -> np.ndarray:
    """Whether a row differs from the row before it in any of the columns; true for the first row."""
    starts = np.zeros(len(columns[0]), dtype=bool)
    starts[0] = True
    for c in columns:
        values = c.to_numpy(zero_copy_only=False)
        starts[1:] |= values[1:] != values[:-1]
    return starts


def _upto(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Running sums that begin anew where a group does; first: row number of each row's group begin."""
    total = np.cumsum(values)
    return total - (total - values)[first]


def scan_in_order(
    df: DataFrame, group: Sequence[str], order: Sequence[str], sums: Sequence[str] = (), lead: Sequence[str] = (),
    rows: int | None = None, name: str = "ordered",
) -> DataFrame:
    """df with nth (from 1, in its group by `order`), last (whether none of its group follows), for each of `sums`
    <column>_upto (sum over the group's rows up to this one) and for each of `lead` next_<column> (null if last).

    group, sums and lead are long columns without nulls; (group, order) should be unique, else equal rows come in any
    order. An empty df gives an empty result.
    """
    rows = df.count() if rows is None else rows
    group, sums, lead = list(group), list(sums), list(lead)
    made = ["nth", *[f"{s}_upto" for s in sums], *[f"next_{c}" for c in lead], "_block", "_row"]
    schema = T.StructType([
        *df.schema.fields, *[T.StructField(c, T.LongType()) for c in made],
        T.StructField("last", T.BooleanType()), T.StructField("_edge", T.BooleanType())])

    def number(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches).combine_chunks()
        n = table.num_rows
        starts = starts_of([table[c].combine_chunks() for c in group])
        row = np.arange(n)
        first = np.maximum.accumulate(np.where(starts, row, 0))
        last = np.r_[starts[1:], True]
        columns = [c.combine_chunks() for c in table.columns]
        columns.append(pa.array(row - first + 1))
        columns += [pa.array(_upto(table[s].to_numpy(), first)) for s in sums]
        for c in lead:
            follows = np.r_[table[c].to_numpy()[1:], 0]
            columns.append(pa.array(follows, mask=last))
        columns += [pa.array(np.full(n, TaskContext.get().partitionId(), dtype=np.int64)), pa.array(row),
                    pa.array(last), pa.array((row == 0) | (row == n - 1))]
        names = [*table.column_names, *made, "last", "_edge"]
        yield from pa.table(columns, names=names).to_batches(max_chunksize=20_000)

    key = [*group, *order]
    dealt = df.repartitionByRange(blocks_for(rows), *key).sortWithinPartitions(*key)
    numbered = stage(dealt.mapInArrow(number, schema), name)

    totals = ["nth", *[f"{s}_upto" for s in sums]]
    borders: dict[int, list] = {}
    for r in numbered.where("_edge").select("_block", "_row", *group, *totals, *lead).collect():  # two a block
        borders.setdefault(r["_block"], []).append(r)
    fixes, before, carried = [], None, [0] * len(totals)
    for block in sorted(borders):
        edge = sorted(borders[block], key=lambda r: r["_row"])
        head, tail = edge[0], edge[-1]
        of = [head[g] for g in group]
        goes_on = before == of
        if goes_on:
            fixes[-1][-1 - len(lead):] = [False, *[head[c] for c in lead]]
        add = carried if goes_on else [0] * len(totals)
        fixes.append([block, *of, *add, True, *[None] * len(lead)])
        whole = [tail[g] for g in group] == of
        carried = [tail[t] + (a if whole else 0) for t, a in zip(totals, add, strict=True)]
        before = [tail[g] for g in group]
    ddl = ", ".join([
        "_b long", *[f"_g{i} long" for i in range(len(group))], *[f"_a{i} long" for i in range(len(totals))],
        "_ends boolean", *[f"_n{i} long" for i in range(len(lead))]])
    fix = F.broadcast(df.sparkSession.createDataFrame([tuple(f) for f in fixes], ddl))  # one row a block
    of_head = F.lit(True)
    for i, g in enumerate(group):
        of_head = of_head & (F.col(g) == F.col(f"_g{i}"))
    ends_block = F.col("last") & F.col("_edge") & (F.col("_row") == F.col("_size") - 1)
    sizes = F.broadcast(df.sparkSession.createDataFrame(
        [(b, max(r["_row"] for r in e) + 1) for b, e in borders.items()], "_b long, _size long"))
    joined = numbered.join(fix.join(sizes, "_b"), F.col("_block") == F.col("_b"))
    return joined.select(
        *df.columns,
        *[(F.col(t) + F.when(of_head, F.col(f"_a{i}")).otherwise(0)).alias(t) for i, t in enumerate(totals)],
        *[F.when(ends_block, F.col(f"_n{i}")).otherwise(F.col(f"next_{c}")).alias(f"next_{c}")
          for i, c in enumerate(lead)],
        F.when(ends_block, F.col("_ends")).otherwise(F.col("last")).alias("last"))


def joined_digests(df: DataFrame, group: Sequence[str], value: str, rows: int | None = None) -> DataFrame:
    """group columns and sha256: of the group's values (long), ascending, as decimals joined by commas.

    Pieces of the joined text are made in blocks of the global order; one hash then runs over a group's pieces, as the
    function allows no other way, with one piece in memory at a time.
    """
    import hashlib

    group = list(group)
    n = blocks_for(df.count() if rows is None else rows)
    fields = [T.StructField(c, T.LongType()) for c in group]

    def pieces(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            cuts = np.flatnonzero(starts_of([batch.column(i) for i in range(len(group))]))
            text = batch.column(len(group)).cast(pa.string())
            ends = np.r_[cuts[1:], batch.num_rows]
            joined = pc.binary_join(pa.ListArray.from_arrays(np.r_[cuts, batch.num_rows].astype(np.int32), text), ",")
            assert len(ends) == len(joined)
            at = pa.array(cuts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).take(at) for i in range(len(group) + 1)] + [joined],
                names=[*group, value, "piece"])

    def hashes(batches):
        of, running = None, None
        for batch in batches:
            keys, found = list(zip(*[batch.column(i).to_pylist() for i in range(len(group))], strict=True)), []
            for key, piece in zip(keys, batch.column(len(group) + 1), strict=True):
                if key == of:
                    running.update(b",")
                else:
                    if of is not None:
                        found.append((*of, running.hexdigest()))
                    of, running = key, hashlib.sha256()
                running.update(piece.as_py().encode())
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], names=names)
        if of is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*of, running.hexdigest())], names=names)

    names = [*group, "sha256"]
    cut = T.StructType([*fields, T.StructField(value, T.LongType()), T.StructField("piece", T.StringType())])
    hashed = T.StructType([*fields, T.StructField("sha256", T.StringType())])
    chosen = df.select(*group, value)
    cut_up = chosen.repartitionByRange(n, *group, value).sortWithinPartitions(*group, value).mapInArrow(pieces, cut)
    return cut_up.repartition(n, *group).sortWithinPartitions(*group, value).mapInArrow(hashes, hashed)
