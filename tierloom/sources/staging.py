"""Intermediate tables in the shared folder the cluster names in spark.checkpoint.dir.

A staged table cuts the lineage, survives the loss of executors, is read column by column, and has a size
Spark knows at planning time. with_size_check uses that size to decide between a broadcast and a sort-merge join
(with skew splitting).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest stored size at which a table is broadcast on purpose; in memory it can be several times as large.
BROADCAST_LIMIT_BYTES = 10 << 20


def staging_root(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; without it one below the warehouse, which executors share too."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/staging"
    if root.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{root} is a folder of this machine alone: name one that all executors share in spark.checkpoint.dir")
    return root


# Folders staged in the innermost temporary_tables block; threads have blocks of their own.
_created: ContextVar[list[str] | None] = ContextVar("staged_folders", default=None)


def staged_path(spark: SparkSession, name: str) -> str:
    path = f"{staging_root(spark)}/tierloom/{name}-{uuid.uuid4().hex}"
    scope = _created.get()
    if scope is not None:
        scope.append(path)
    return path


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Removes the tables staged inside the block when it ends; nothing read from them may be used after it.

    Tables of other threads and of enclosing blocks stay.
    """
    own: list[str] = []
    outer = _created.set(own)
    try:
        yield
    finally:
        _created.reset(outer)
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for path in own:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(hadoop).delete(target, True)


def stage(df: DataFrame, name: str, row_group_bytes: int | None = None) -> DataFrame:
    """Write df once as Parquet and return the table read back.

    Small row groups let later scans split the table into many tasks where the work per row is heavy.
    """
    path = staged_path(df.sparkSession, name)
    writer = df.write.mode("errorifexists")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_size_check(df: DataFrame, limit_bytes: int | None = None) -> DataFrame:
    """The lookup side of a join: marked for broadcast if its planned size is within the limit, else unchanged.

    Meant for tables read from storage, whose planned size is the size of their files. Unmarked tables are joined
    by sort-merge, where adaptive execution splits hot keys of the other side.
    """
    limit = BROADCAST_LIMIT_BYTES if limit_bytes is None else limit_bytes
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= limit else df
