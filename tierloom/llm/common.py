"""What the text operators share: whole texts in bounded chunks, bounded caches, staged scans.

Every operator takes a DataFrame with at least doc_id and text, reads only the columns it needs (so further columns,
whatever their names, do not matter) and returns doc_id with its own columns. A null text counts as the empty text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text bytes a task turns into Python objects at a time. A longer text is a chunk of its own.
CHUNK_BYTES = 2 << 20

# Characters that str.split() takes for white space although they do not have the property White_Space.
_ONLY_PYTHON_SPACES = "\x1c\x1d\x1e\x1f"


class BoundedCache(dict):
    """value = make(key), kept for repeated keys; emptied when it holds `bound` entries. Long keys are not kept."""

    def __init__(self, make: Callable, bound: int = 120_000, longest: int = 64):
        super().__init__()
        self.make, self.bound, self.longest = make, bound, longest

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.bound:
                self.clear()
            self[key] = value
        return value


class Generations(dict):
    """value = make(key), kept for repeated keys in two generations of at most `bound` entries together.

    When the younger one is full the older is forgotten, so what is met often stays. Long keys are not kept.
    """

    def __init__(self, make: Callable | None, bound: int, longest: int = 48):
        super().__init__()
        self.make, self.half, self.longest = make, max(1, bound // 2), longest
        self.old: dict = {}

    def __missing__(self, key):
        value = self.old.pop(key, None)
        if value is None:
            value = self.make(key)
        self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(key) <= self.longest:
            if len(self) >= self.half:
                self.old = {}
                self.old = self.copy()
                self.clear()
            self[key] = value

    def known(self, key):
        """The value if it is kept, else None."""
        value = self.get(key)
        if value is None and (value := self.old.pop(key, None)) is not None:
            self.keep(key, value)
        return value


def text_chunks(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most CHUNK_BYTES of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        end = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = end[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(end, before + CHUNK_BYTES, side="right")))
            yield batch.slice(at, upto - at)
            at = upto


def texts_of(chunk: pa.RecordBatch, column: str = "text") -> list[str]:
    return [x or "" for x in chunk.column(chunk.schema.get_field_index(column)).to_pylist()]


def white_space_tokens(text: str) -> list[str]:
    """Maximal runs of characters without the property White_Space."""
    if any(c in text for c in _ONLY_PYTHON_SPACES):
        return [x for x in _spaces().split(text) if x]
    return text.split()


def _spaces():
    import re

    return re.compile("[\t-\r \x85\xa0  -     　]+")


def column_of(df: DataFrame, name: str, alias: str | None = None):
    return F.col(f"`{name}`").alias(alias or name)


def neutral(docs: DataFrame) -> DataFrame:
    """docs with every column but doc_id and text under a name of its position, so that new columns cannot clash."""
    return docs.toDF(*[c if c in ("doc_id", "text") else f"_{i}" for i, c in enumerate(docs.columns)])


def named_again(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of neutral(docs) in rows, under their names and in their order in docs."""
    return rows.select(*neutral(docs).columns).toDF(*docs.columns)


def map_texts(
    docs: DataFrame, fields: Sequence[tuple[str, str]], work: Callable[..., Sequence], keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """The columns `keep`, then those that work(texts) returns for a chunk of whole texts, in the order of `fields`.

    fields: (name, Spark type). The scan reads the kept columns and text only. Rows stay in the task that read them.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    made = T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in fields))
    schema = T.StructType([T.StructField(c, docs.schema[c].dataType) for c in keep] + made.fields)
    arrow = to_arrow_schema(schema)
    kept = len(keep)

    def run(batches):
        for chunk in text_chunks(batches):
            columns = work(texts_of(chunk))
            arrays = [chunk.column(i).cast(arrow.field(i).type) for i in range(kept)]
            arrays += [pa.array(c, type=arrow.field(kept + i).type) for i, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return docs.select(*[column_of(docs, c) for c in dict.fromkeys([*keep, "text"])]).mapInArrow(run, schema)
