"""Shapley contributions of the features to the cluster a row belongs to."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.functions.columns import model_key
from tierloom.functions.sampling import hash_order, in_fraction, uniform
from tierloom.functions.vectors import nearest
from tierloom.operators.scoring import with_model
from tierloom.operators.topn import top_n_per_group
from tierloom.sources.staging import stage, with_size_check
from tierloom.sources.tables import read_table


def select_segments(models: DataFrame, prefix: str = "") -> DataFrame:
    """Models whose key starts with the prefix, ignoring case; an empty prefix selects all."""
    return models.where(F.lower("segment_key").startswith(prefix.lower())) if prefix else models


def scaled_labelled(
    rows: DataFrame, models: DataFrame, segment_col: str = "SEGMENT",
    industry_col: str = "MOST_RECENT_INDUSTRY_CODE_DESC", label_col: str | None = None,
) -> DataFrame:
    """CUSTOMER_ID, SEGMENT_KEY, Z, CLUSTER_LABEL of the rows that have a model and all features.

    The label is that of the closest centre, or the table's own in label_col; a row whose own label is none of its model's
    clusters is left out.
    """
    key = model_key(F.col(industry_col), F.col(segment_col))
    found = with_model(rows, models, key).where(F.col("Z").isNotNull())
    if label_col is None:
        found = found.withColumn("CLUSTER_LABEL", F.expr(f"({nearest('Z', 'centroids')}).label"))
    else:
        found = found.withColumn("CLUSTER_LABEL", F.col(label_col.upper()).try_cast("int")).where(
            "CLUSTER_LABEL between 0 and size(centroids) - 1")
    return found.select("CUSTOMER_ID", "SEGMENT_KEY", "Z", "CLUSTER_LABEL")


def explain_models(
    customers: DataFrame, models: DataFrame, run_id: str, run_timestamp: str, background_fraction: float = 1.0, max_rows: int = 0,
    segment_col: str = "SEGMENT",
) -> DataFrame:
    """cluster_shap of all clustered models, with TARGET (the table a model names for its rows, else null).

    A model may name its input table, the features to report (x_cols) and the column that holds the labels (y_col); what it
    does not name comes from `customers`, all its features, and the closest centre. Models that name the same are handled
    together, and there are few such kinds. No rows if no model is clustered. models: staged.
    """
    parts = []
    named = ["input_table", "features", "x_cols", "y_col", "output_table"]
    for kind in models.where("status = 'CLUSTERED'").select(named).distinct().collect():
        same = F.lit(True)
        for c in named:
            value = F.array(*[F.lit(x) for x in kind[c]]).cast("array<string>") if isinstance(kind[c], list) else F.lit(kind[c])
            same = same & F.col(c).eqNullSafe(value)
        own = models.where("status = 'CLUSTERED'").where(same)
        rows = read_table(customers.sparkSession, kind["input_table"]) if kind["input_table"] else customers
        labelled = stage(scaled_labelled(rows, own, segment_col, label_col=kind["y_col"]), "labelled")
        shap = cluster_shap(labelled, own, kind["features"], run_id, run_timestamp, background_fraction, max_rows)
        if kind["x_cols"]:
            wanted = F.array(*[F.lit(c.upper()) for c in kind["x_cols"]])
            shap = shap.withColumn("CLUSTER_SHAP", F.map_filter("CLUSTER_SHAP", lambda f, _: F.array_contains(wanted, F.upper(f))))
        parts.append(shap.withColumn("TARGET", F.lit(kind["output_table"]).cast("string")))
    none = "SEGMENT string, CLUSTER int, CLUSTER_SHAP map<string, double>, RUNID string, RUNTIMESTAMP string, TARGET string"
    return reduce(DataFrame.unionByName, parts) if parts else customers.sparkSession.createDataFrame([], none)


def background_moments(labelled: DataFrame, dims: int, fraction: float) -> DataFrame:
    """SEGMENT_KEY, M1, M2: means of z and z^2 over the background sample (all rows if it is empty)."""
    picked = in_fraction(fraction, "CUSTOMER_ID")

    def mean(x: Column) -> Column:
        return F.coalesce(F.avg(F.when(picked, x)), F.avg(x))

    z = [F.col("Z")[j] for j in range(dims)]
    return labelled.groupBy("SEGMENT_KEY").agg(
        F.array(*[mean(x) for x in z]).alias("M1"), F.array(*[mean(x * x) for x in z]).alias("M2"))


def cluster_shap(
    labelled: DataFrame, models: DataFrame, features: Sequence[str], run_id: str, run_timestamp: str,
    background_fraction: float = 1.0, max_rows: int = 0,
) -> DataFrame:
    """SEGMENT, CLUSTER, CLUSTER_SHAP (feature -> mean absolute contribution), RUNID, RUNTIMESTAMP.

    Explained is the squared distance to the row's own centroid. It is additive over the features, so the
    Shapley value of feature j is exactly (z_j - c_j)^2 minus its background mean, and no sampling of feature
    coalitions is needed. All rows are explained against all rows; background_fraction and max_rows (rows per
    segment) make both fewer. `labelled` comes from scaled_labelled, best staged.
    """
    dims = len(features)
    context = stage(
        background_moments(labelled, dims, background_fraction).join(
            models.select(F.col("segment_key").alias("SEGMENT_KEY"), "centroids"), "SEGMENT_KEY"),
        "explain-context")
    if max_rows > 0:
        labelled = top_n_per_group(
            labelled, ["SEGMENT_KEY"], [hash_order("CUSTOMER_ID"), F.col("CUSTOMER_ID")], max_rows)

    def contribution(j: int) -> Column:
        c = F.get("centroids", F.col("CLUSTER_LABEL"))[j]
        d = F.col("Z")[j] - c
        return d * d - (F.col("M2")[j] - 2 * c * F.col("M1")[j] + c * c)

    pairs = [x for j, f in enumerate(features) for x in (F.lit(f), F.avg(F.abs(contribution(j))))]
    return (
        labelled.join(with_size_check(context), "SEGMENT_KEY")
        .groupBy("SEGMENT_KEY", "CLUSTER_LABEL")
        .agg(F.create_map(*pairs).alias("CLUSTER_SHAP"))
        .select(
            F.col("SEGMENT_KEY").alias("SEGMENT"), F.col("CLUSTER_LABEL").alias("CLUSTER"), "CLUSTER_SHAP",
            F.lit(run_id).alias("RUNID"), F.lit(run_timestamp).alias("RUNTIMESTAMP"))
    )


def cluster_shap_label(
    labelled: DataFrame, models: DataFrame, features: Sequence[str], run_id: str, run_timestamp: str,
    draws: int = 8, background_rows: int = 100, max_rows: int = 0, seed: int = 42,
) -> DataFrame:
    """As cluster_shap, for the hard label "row falls into its cluster", estimated from random permutations.

    Every explained row makes `draws` draws of a feature order and one background row. A feature contributes the
    change of the label indicator when it switches from the background value to the row's own. The background is
    a fixed-size hash sample per segment, so the segment context has a bounded size.
    """
    dims = len(features)
    order = [hash_order("CUSTOMER_ID"), F.col("CUSTOMER_ID")]
    background = (
        top_n_per_group(labelled, ["SEGMENT_KEY"], order, background_rows)
        .groupBy("SEGMENT_KEY").agg(F.array_sort(F.collect_list(F.struct("CUSTOMER_ID", "Z"))).alias("__bg")))
    context = stage(
        background.join(models.select(F.col("segment_key").alias("SEGMENT_KEY"), "centroids"), "SEGMENT_KEY"),
        "explain-context")
    if max_rows > 0:
        labelled = top_n_per_group(labelled, ["SEGMENT_KEY"], order, max_rows)
    rank = [uniform(seed, F.col("__draw"), F.col("CUSTOMER_ID"), F.lit(j)) for j in range(dims)]
    at = F.floor(uniform(seed, F.col("__draw"), F.col("CUSTOMER_ID"), F.lit("bg")) * F.size("__bg")).cast("int")
    drawn = (
        labelled.join(with_size_check(context), "SEGMENT_KEY")
        .withColumn("__draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
        .withColumn("__b", F.get("__bg", at)["Z"])
        .withColumn("__r", F.array(*rank))
        .drop("__bg")
    )

    # Place of each feature in the drawn order; step t has the first t features switched to the row's values.
    place = [" + ".join(f"int(__r[{i}] < __r[{j}])" for i in range(dims) if i != j) or "0" for j in range(dims)]
    drawn = drawn.withColumns({f"__p{j}": F.expr(p) for j, p in enumerate(place)})
    drawn = drawn.withColumns({
        f"__h{t}": F.expr(f"array({', '.join(f'if(__p{j} < {t}, Z[{j}], __b[{j}])' for j in range(dims))})")
        for t in range(dims)})
    hits = [f"int(({nearest(f'__h{t}', 'centroids', dims)}).label = CLUSTER_LABEL)" for t in range(dims)]
    steps = drawn.withColumn("__v", F.expr(f"array({', '.join(hits)}, 1)"))
    moves = steps.select(
        "SEGMENT_KEY", "CLUSTER_LABEL", "CUSTOMER_ID",
        *[F.expr(f"__v[__p{j} + 1] - __v[__p{j}] as __m{j}") for j in range(dims)])
    per_row = moves.groupBy("SEGMENT_KEY", "CLUSTER_LABEL", "CUSTOMER_ID").agg(
        *[F.avg(f"__m{j}").alias(f"__m{j}") for j in range(dims)])
    pairs = [x for j, f in enumerate(features) for x in (F.lit(f), F.avg(F.abs(f"__m{j}")))]
    return (
        per_row.groupBy("SEGMENT_KEY", "CLUSTER_LABEL").agg(F.create_map(*pairs).alias("CLUSTER_SHAP"))
        .select(
            F.col("SEGMENT_KEY").alias("SEGMENT"), F.col("CLUSTER_LABEL").alias("CLUSTER"), "CLUSTER_SHAP",
            F.lit(run_id).alias("RUNID"), F.lit(run_timestamp).alias("RUNTIMESTAMP"))
    )
