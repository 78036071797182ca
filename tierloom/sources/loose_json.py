"""JSON documents of unknown shape, as VARIANT: no fixed schema, unknown keys kept, bad documents reported as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATISTICS = {"p1": "BASE_P1", "p99": "BASE_P99", "mean": "BASE_MEAN", "null_pct": "BASE_NULL_PCT"}


def leaves(documents: DataFrame, column: str = "value", depth: int = 4, key: str = "DOCUMENT") -> DataFrame:
    """key, PATH (array of names and places), VALUE (text), KIND of every scalar, and of empty objects and arrays, down to
    `depth` levels (what lies deeper comes as JSON text). documents: key and the text column."""
    found = documents.select(key, F.expr(f"try_parse_json(`{column}`)").alias("v")).where("v is not null").select(
        key, F.array().cast("array<string>").alias("PATH"), "v")
    done = []
    for _ in range(depth):
        kind = F.schema_of_variant("v")
        nested = (kind.startswith("OBJECT<") & (kind != "OBJECT<>")) | (kind.startswith("ARRAY<") & (kind != "ARRAY<VOID>"))
        done.append(found.where(~nested))
        exploded = documents.sparkSession.tvf.variant_explode(F.col("v").outer()).toDF("__pos", "__name", "__inner")
        found = found.where(nested).lateralJoin(exploded).select(
            key, F.concat("PATH", F.array(F.coalesce("__name", F.col("__pos").cast("string")))).alias("PATH"), F.col("__inner").alias("v"))
    every = found
    for d in done:
        every = every.unionByName(d)
    return every.select(key, "PATH", F.col("v").cast("string").alias("VALUE"), F.schema_of_variant("v").alias("KIND"))


def baseline_rows(documents: DataFrame, column: str = "value", key: str = "DOCUMENT") -> DataFrame:
    """key, FEATURE, BASE_P1, BASE_P99, BASE_MEAN, BASE_NULL_PCT, EXTRA (map of further keys), PROBLEM.

    A feature is an object with at least one known statistic, at the top of the document or under any one key of it.
    Statistics that are no number are null. A document that is no JSON, or holds no feature, gives a row with PROBLEM only.
    """
    every = leaves(documents, column, key=key)
    owner = F.expr("slice(PATH, 1, greatest(size(PATH) - 1, 0))")
    named = every.where(F.size("PATH").between(2, 3)).select(
        key, owner.alias("OWNER"), F.try_element_at("PATH", F.lit(-1)).alias("NAME"), "VALUE").groupBy(key, "OWNER").agg(
        F.map_from_entries(F.collect_list(F.struct("NAME", "VALUE"))).alias("M"))
    known = F.array(*[F.lit(s) for s in STATISTICS])
    rows = named.where(F.arrays_overlap(F.map_keys("M"), known)).select(
        key, F.try_element_at("OWNER", F.lit(-1)).alias("FEATURE"),
        *[F.expr(f"try_cast(M['{s}'] as double)").alias(name) for s, name in STATISTICS.items()],
        F.map_filter("M", lambda k, _: ~F.array_contains(known, k)).alias("EXTRA"), F.lit(None).cast("string").alias("PROBLEM"))
    readable = documents.select(key, F.expr(f"try_parse_json(`{column}`) is not null").alias("ok"))
    bad = readable.join(rows.select(key).distinct(), key, "left_anti").select(
        key, *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns[1:-1]],
        F.when(F.col("ok"), "no feature").otherwise("no JSON").alias("PROBLEM"))
    return rows.unionByName(bad)
