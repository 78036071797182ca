"""Cluster assignment of new rows with stored models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.functions.columns import model_key, to_number
from tierloom.functions.vectors import complete_vector, nearest, scaled, vector_literal
from tierloom.operators.quantiles import exact_quantiles, long_features
from tierloom.sources.staging import with_size_check
from tierloom.sources.tables import normalized_scan

NO_MODEL = -1


def with_model(rows: DataFrame, models: DataFrame, key: Column) -> DataFrame:
    """Rows (upper-case names) with SEGMENT_KEY, their model's centroids, and Z, the scaled feature vector.

    Z takes the model's features by name, whatever their type: 0.0 for a column the table lacks, and it is NULL
    without a model or if a value is missing or no number. Only columns that some model names are read. `models` is a model table, normally read from storage, so its size is known: it is
    broadcast while it is small, and otherwise hot segments are split on the row side of the left join. Feature
    names are resolved to positions on the model side.
    """
    df = normalized_scan(rows)
    # The distinct feature names of the models: as many as the table has columns, at most.
    wanted = {r["f"] for r in models.select(F.explode("features").alias("f")).select(F.upper("f").alias("f")).distinct().collect()}
    names = [n for n in df.columns if n in wanted]
    known = F.array(*[F.lit(n) for n in names]).cast("array<string>")
    table = models.where(F.col("status") == "CLUSTERED").select(
        F.col("segment_key").alias("SEGMENT_KEY"),
        F.transform("features", lambda f: F.array_position(known, F.upper(f)).cast("int")).alias("__at"),
        "center", "scale", "centroids")
    values = F.array(*[to_number(F.col(n)) for n in names]).cast("array<double>")
    pick = "transform(__at, i -> case when i = 0 then 0D else __values[i - 1] end)"
    return (
        df.withColumn("SEGMENT_KEY", key).withColumn("__values", values)
        .join(with_size_check(table), "SEGMENT_KEY", "left")
        .withColumn("__x", F.expr(pick))
        .withColumn("__x", F.expr("case when not exists(__x, v -> v is null) then __x end"))
        .withColumn("Z", F.expr(scaled("__x", "center", "scale")))
        .drop("__values", "__at", "__x", "center", "scale")
    )


def label_rows(rows: DataFrame, models: DataFrame, key: Column) -> DataFrame:
    """Rows with SEGMENT_KEY and CLUSTER_LABEL; -1 without a model or with a missing feature value."""
    return (
        with_model(rows, models, key)
        .withColumn("CLUSTER_LABEL", F.expr(f"coalesce(({nearest('Z', 'centroids')}).label, {NO_MODEL})"))
        .drop("Z", "centroids")
    )


def score_segments(
    rows: DataFrame, models: DataFrame, run_id: str, scored_at: str, segment_col: str = "SEGMENT",
    industry_col: str = "MOST_RECENT_INDUSTRY_CODE_DESC",
) -> DataFrame:
    """CUSTOMER_ID, SEGMENT, CLUSTER_LABEL, RUNID, SCORED_AT_UTC."""
    scored = label_rows(rows, models, model_key(F.col(industry_col), F.col(segment_col)))
    return scored.select(
        "CUSTOMER_ID", F.col(segment_col).alias("SEGMENT"), "CLUSTER_LABEL",
        F.lit(run_id).alias("RUNID"), F.lit(scored_at).alias("SCORED_AT_UTC"))


def score_by_key(
    rows: DataFrame, models: DataFrame, segment_col: str = "SEGMENT",
    industry_col: str = "MOST_RECENT_INDUSTRY_CODE_DESC",
) -> DataFrame:
    """CUSTOMER_ID, SEGMENT_KEY, CLUSTER_LABEL."""
    return label_rows(rows, models, model_key(F.col(industry_col), F.col(segment_col))).select(
        "CUSTOMER_ID", "SEGMENT_KEY", "CLUSTER_LABEL")


def score_global(rows: DataFrame, model: DataFrame, run_id: str, scored_at: str) -> DataFrame:
    """Scores every row with one model for the whole table; keeps all columns.

    Missing values take the median of their column, columns the table lacks are added as NULL and imputed the
    same way (they stay NULL and give label -1, because they have no median). The model row and one median per
    feature are the only things read on the driver.
    """
    m = model.select("features", "center", "scale", "centroids").first()
    features = [f.upper() for f in m["features"]]
    df = normalized_scan(rows)
    df = df.withColumns({f: F.lit(None).cast("double") for f in features if f not in df.columns})
    df = df.withColumns({f: to_number(F.col(f)) for f in features})
    medians = {r["FEATURE"]: r["Q"][0] for r in exact_quantiles(
        long_features(df, [], features), ["FEATURE"], [0.5]).collect()}
    df = df.withColumns({f: F.coalesce(F.col(f), F.lit(medians.get(f)).cast("double")) for f in features})

    centroids = ", ".join(vector_literal(c) for c in m["centroids"])
    z = scaled("__x", vector_literal(m["center"]), vector_literal(m["scale"]))
    return (
        df.withColumn("__x", F.expr(complete_vector(features)))
        .withColumn("__z", F.expr(z))
        .withColumn("__near", F.expr(nearest("__z", f"array({centroids})", len(features))))
        .withColumns({
            "CLUSTER_LABEL": F.coalesce("__near.label", F.lit(NO_MODEL)).cast("bigint"),
            "RUNID": F.lit(run_id),
            "SCORED_AT_UTC": F.lit(scored_at)})
        .drop("__x", "__z", "__near")
    )
