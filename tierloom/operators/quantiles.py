"""Exact quantiles per group without holding a group in one task.

The built-in exact percentile keeps every distinct value of a group in one aggregation buffer. Here a sketch
(`percentile_approx`, mergeable, bounded) brackets each wanted quantile; the second pass counts rows outside
the brackets and keeps single values only inside them, a fraction of about 6 / accuracy of the rows each. Values
are ordered per bracket, so a task sorts at most that fraction; raise `accuracy` for very large groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierloom.functions.columns import to_number
from tierloom.sources.staging import stage, with_size_check


def long_features(df: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """One row per (keys, FEATURE) with the numeric VALUE; bad values are NULL."""
    numbers = df.select(*keys, *[to_number(F.col(f)).alias(f) for f in features])
    return numbers.unpivot(list(keys), list(features), "FEATURE", "VALUE")


def exact_quantiles(
    values: DataFrame, by: Sequence[str], probs: Sequence[float], value: str = "VALUE", accuracy: int = 10_000,
    discrete: bool = False,
) -> DataFrame:
    """by..., N, Q: array of the linearly interpolated quantiles of the non-NULL values, in the order of probs.

    A discrete quantile is the smallest value that at least the share p of the values does not exceed. `by` columns must
    not be NULL. The input is read twice; stage it first when it is expensive.
    """
    by = list(by)
    margin = 3.0 / accuracy
    m = len(probs)
    order = sorted(range(m), key=lambda i: probs[i])
    lows = [max(0.0, probs[i] - margin) for i in order]
    highs = [min(1.0, probs[i] + margin) for i in order]

    rows = values.select(*by, F.col(value).alias("__x")).where(F.col("__x").isNotNull())
    sketch = rows.groupBy(*by).agg(
        F.count("__x").alias("N"),
        F.percentile_approx("__x", lows + highs, accuracy).alias("__b"),
    )
    sketch = stage(
        sketch.select(*by, "N", F.slice("__b", 1, m).alias("__lo"), F.slice("__b", m + 1, m).alias("__hi")),
        "quantile-brackets",
    )

    slot = F.size(F.filter("__lo", lambda b: b <= F.col("__x")))
    inside = (F.col("__slot") > 0) & (F.col("__x") <= F.try_element_at("__hi", F.col("__slot")))
    entries = stage(
        rows.join(with_size_check(sketch), by)
        .withColumn("__slot", slot)
        .withColumn("__v", F.when(inside, F.col("__x")))
        .groupBy(*by, "N", "__slot", "__v")
        .agg(F.count(F.lit(1)).alias("__c"), F.min("__x").alias("__min"), F.max("__x").alias("__max")),
        "quantile-entries")
    # Slots follow each other in value order, so ranks are a start per slot plus a running count inside it.
    earlier = Window.partitionBy(*by).orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        entries.groupBy(*by, "__slot").agg(F.sum("__c").alias("__t"))
        .withColumn("__start", F.coalesce(F.sum("__t").over(earlier), F.lit(0))).drop("__t"))
    within = Window.partitionBy(*by, "__slot").orderBy("__min").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        entries.join(starts, [*by, "__slot"])
        .withColumn("__upto", F.col("__start") + F.sum("__c").over(within))
        .withColumn("__before", F.col("__upto") - F.col("__c")))

    def at_rank(k: Column) -> Column:
        # Ends of a counted stretch are known exactly, its inner values are never needed.
        picked = (
            F.when(F.col("__v").isNotNull(), F.col("__v"))
            .when(k == F.col("__before"), F.col("__min"))
            .when(k == F.col("__upto") - 1, F.col("__max"))
        )
        return F.max(F.when((F.col("__before") <= k) & (k < F.col("__upto")), picked))

    aggs = []
    for i, p in enumerate(probs):
        # A discrete rank is one of the two an interpolation looks at, so the brackets hold it too.
        k = F.greatest(F.ceil(F.round(F.lit(float(p)) * F.col("N"), 6)) - 1, F.lit(0)) if discrete else F.floor(
            F.lit(float(p)) * (F.col("N") - 1))
        aggs += [at_rank(k).alias(f"__a{i}"), at_rank(k + 1).alias(f"__z{i}")]
    found = ranked.groupBy(*by, "N").agg(*aggs)

    def interpolated(i: int, p: float) -> Column:
        rank = F.lit(float(p)) * (F.col("N") - 1)
        part = rank - F.floor(rank)
        a, z = F.col(f"__a{i}"), F.col(f"__z{i}")
        q = a if discrete else F.when(part == 0, a).otherwise(a + (z - a) * part)
        return F.coalesce(q, F.raise_error(F.lit("quantile bracket missed its rank")).cast("double"))

    return found.select(*by, "N", F.array(*[interpolated(i, p) for i, p in enumerate(probs)]).alias("Q"))
