"""Reproducible pseudo-random order and row selection from a row key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_order(*keys: str) -> Column:
    """md5 of the key text: a fixed pseudo-random order that every SQL engine can rebuild."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))


def in_fraction(fraction: float, *keys: str) -> Column:
    """True for about `fraction` of the rows, always the same ones for the same keys."""
    if fraction >= 1.0:
        return F.lit(True)
    bound = format(int(max(fraction, 0.0) * 2 ** 32), "08x")
    return F.substring(hash_order(*keys), 1, 8) < bound


def uniform(*parts) -> Column:
    """Uniform number in (0, 1) from a hash of the given columns and constants."""
    h = F.xxhash64(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / F.lit(2.0 ** 53)
