"""A run's models as a SQL function, so that rows can be scored in any query without this library."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.operators.scoring import NO_MODEL

# The function's text holds every centre; larger runs are scored by a join (operators.scoring).
MOST_MODELS = 2000


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _number(x: float) -> str:
    return f"cast({x!r} as double)" if x in (float("inf"), float("-inf")) or x != x else f"{float(x)!r}D"


def _label(model, place: dict[str, str]) -> str:
    """The closest centre of one model, the first on a tie, as nested comparisons of squared distances."""
    scaled = []
    for f, c, s in zip(model["features"], model["center"] or [None] * len(model["features"]),
                       model["scale"] or [None] * len(model["features"]), strict=True):
        x = place.get(f.upper(), "0D")  # a feature the function has no argument for scores as 0
        x = x if c is None else f"({x} - {_number(c)})"
        scaled.append(x if s is None else f"({x} / {_number(s)})")
    far = [" + ".join(f"power({x} - {_number(y)}, 2)" for x, y in zip(scaled, centre, strict=True)) for centre in model["centroids"]]
    each = ", ".join(f"struct({d} as d2, {i} as label)" for i, d in enumerate(far))
    return f"array_min(array({each})).label"


def function_sql(models: DataFrame, features: Sequence[str], name: str = "assign_cluster", temporary: bool = True) -> str:
    """CREATE FUNCTION name(segment_key, features...) RETURNS INT, from a model table with at most MOST_MODELS models.

    Gives -1 for a key without a clustered model and for a null or non-finite feature that the model uses.
    """
    own = models.where(F.col("status") == "CLUSTERED").select("segment_key", "features", "center", "scale", "centroids")
    rows = own.limit(MOST_MODELS + 1).collect()  # bounded
    if len(rows) > MOST_MODELS:
        raise ValueError(f"more than {MOST_MODELS} models: score by a join instead")
    place = {f.upper(): f"`{f}`" for f in features}
    cases = []
    for m in sorted(rows, key=lambda r: r["segment_key"]):
        used = [place[f.upper()] for f in m["features"] if f.upper() in place]
        whole = " and ".join(f"{x} is not null and abs({x}) < double('Infinity')" for x in used) or "true"
        cases.append(f"when {_text(m['segment_key'])} then if({whole}, {_label(m, place)}, {NO_MODEL})")
    body = f"coalesce(case segment_key {' '.join(cases)} end, {NO_MODEL})" if cases else str(NO_MODEL)
    arguments = ", ".join(["segment_key string", *[f"`{f}` double" for f in features]])
    return f"create or replace {'temporary ' if temporary else ''}function {name}({arguments}) returns int return {body}"


def register(spark: SparkSession, models: DataFrame, features: Sequence[str], name: str = "assign_cluster", temporary: bool = True) -> None:
    spark.sql(function_sql(models, features, name, temporary))
