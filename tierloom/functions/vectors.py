"""SQL text for arithmetic on array<double> vectors and arrays of centroids, for F.expr.

Text instead of nested Column calls, because the same expressions are built again in every k-means iteration
and each Column call is a round trip to the JVM. Arguments are column names or lambda variables.
"""

from __future__ import annotations

from collections.abc import Sequence

_UNROLL = 16


def squared_distance(z: str, c: str, dims: int | None = None) -> str:
    """Squared Euclidean distance. Short vectors of known length are unrolled to plain arithmetic."""
    if dims is not None and dims <= _UNROLL:
        return " + ".join(f"({z}[{j}] - {c}[{j}]) * ({z}[{j}] - {c}[{j}])" for j in range(dims))
    return f"aggregate(zip_with({z}, {c}, (p, q) -> (p - q) * (p - q)), 0D, (total, term) -> total + term)"


def nearest(z: str, centroids: str, dims: int | None = None, most: int | None = None) -> str:
    """struct(d2, label) of the closest centroid; the first one wins a tie. NULL z gives NULL.

    With `most`, a bound on the number of centroids, the comparison is unrolled: code generation covers it, which
    it does not for functions on arrays.
    """
    if dims is not None and dims <= _UNROLL and most is not None and 2 <= most <= _UNROLL:
        each = ", ".join(
            f"if(size({centroids}) > {i}, struct({squared_distance(z, f'get({centroids}, {i})', dims)} as d2, "
            f"{i} as label), null)" for i in range(most))
        return f"case when {z} is not null then least({each}) end"
    return (
        f"case when {z} is not null then array_min(transform({centroids}, (ctr, pos) -> "
        f"struct({squared_distance(z, 'ctr', dims)} as d2, cast(pos as int) as label))) end")


def scaled(x: str, center: str, scale: str) -> str:
    """(x - center) / scale; no center means no shift, no scale means no division."""
    shifted = f"case when {center} is null then {x} else zip_with({x}, {center}, (p, q) -> p - q) end"
    return f"case when {scale} is null then {shifted} else zip_with({shifted}, {scale}, (p, q) -> p / q) end"


def complete_vector(columns: Sequence[str]) -> str:
    """array(columns), or NULL as soon as one entry is NULL."""
    nulls = " or ".join(f"`{c}` is null" for c in columns)
    return f"case when not ({nulls}) then array({', '.join(f'`{c}`' for c in columns)}) end"


def vector_literal(values: Sequence[float] | None) -> str:
    if values is None:
        return "cast(null as array<double>)"
    return f"array({', '.join(f'{float(v)!r}D' for v in values)})"
