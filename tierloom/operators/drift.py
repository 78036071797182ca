"""Drift of features (PSI over baseline deciles, moments against stored statistics) and of cluster shares (KL)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.functions.columns import kl_term, psi_term, status_of_rank, status_rank, step_status
from tierloom.operators.quantiles import exact_quantiles, long_features
from tierloom.sources.staging import stage

# Ten equal steps from 0 to 1, computed as i * 0.1.
DECILES = [i * 0.1 for i in range(10)] + [1.0]
MIN_SAMPLES = 50


def drift_edges(baseline: DataFrame, features: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """FEATURE, BASE_N, EDGES: distinct baseline deciles in ascending order. All-NULL features have no row."""
    q = exact_quantiles(long_features(baseline, [], features), ["FEATURE"], DECILES, accuracy=accuracy)
    return q.select("FEATURE", F.col("N").alias("BASE_N"), F.array_sort(F.array_distinct("Q")).alias("EDGES"))


def bin_index(value, edges):
    """Bin of [e_i, e_i+1), the last one closed; NULL outside the edges."""
    last = F.element_at(edges, -1)
    at = F.size(F.filter(edges, lambda e: e <= value)) - 1
    return F.when(value == last, F.size(edges) - 2).when((at >= 0) & (value < last), at)


def _bin_counts(baseline: DataFrame, current: DataFrame, features: Sequence[str], edges: DataFrame) -> DataFrame:
    """FEATURE, BIN (NULL = out of range, or too few edges), BASE_COUNT, CUR_COUNT of the non-NULL values.

    Both tables go through one aggregate. The edges are one row per feature column, hence the broadcast.
    """
    sides = long_features(baseline, [], features).withColumn("__cur", F.lit(0)).unionByName(
        long_features(current, [], features).withColumn("__cur", F.lit(1)))
    found = F.when(F.size("EDGES") >= 3, bin_index(F.col("VALUE"), F.col("EDGES")))
    return (
        sides.where(F.col("VALUE").isNotNull())
        .join(F.broadcast(edges.select("FEATURE", "EDGES")), "FEATURE")
        .groupBy("FEATURE", found.alias("BIN"))
        .agg(F.count_if(F.col("__cur") == 0).alias("BASE_COUNT"), F.count_if(F.col("__cur") == 1).alias("CUR_COUNT"))
    )


def drift_hist(baseline: DataFrame, current: DataFrame, features: Sequence[str], edges: DataFrame) -> DataFrame:
    """FEATURE, BIN (NULL = out of range), BASE_COUNT, CUR_COUNT for the features with at least 3 edges."""
    return _bin_counts(baseline, current, features, edges.where(F.size("EDGES") >= 3))


def drift_psi(
    baseline: DataFrame, current: DataFrame, features: Sequence[str], warn: float = 0.10, fail: float = 0.25,
    min_samples: int = MIN_SAMPLES, accuracy: int = 10_000,
) -> DataFrame:
    """FEATURE, PSI, NOTE, OUT_OF_RANGE_SHARE, STATUS: one row per feature.

    Values outside the baseline range are left out of the shares and reported as OUT_OF_RANGE_SHARE. A feature that a
    side lacks gets a note and no PSI.
    """
    spark = baseline.sparkSession
    features = list(features)
    lacking = {
        side: [f for f in features if f not in df.columns] for side, df in (("baseline", baseline), ("current", current))}
    baseline, current = (
        df.withColumns({f: F.lit(None).cast("double") for f in lacking[side]})
        for side, df in (("baseline", baseline), ("current", current)))
    edges = stage(drift_edges(baseline, features, accuracy), "drift-edges")
    hist = stage(_bin_counts(baseline, current, features, edges), "drift-hist")
    bins = edges.where(F.size("EDGES") >= 3).select(
        "FEATURE", F.explode(F.sequence(F.lit(0), F.size("EDGES") - 2)).alias("BIN"))
    inside = hist.where(F.col("BIN").isNotNull())
    totals = hist.groupBy("FEATURE").agg(
        F.sum(F.when(F.col("BIN").isNotNull(), F.col("BASE_COUNT"))).alias("__base"),
        F.sum(F.when(F.col("BIN").isNotNull(), F.col("CUR_COUNT"))).alias("__cur"),
        F.sum("CUR_COUNT").alias("__cur_all"))
    shares = bins.join(inside, ["FEATURE", "BIN"], "left").join(totals, "FEATURE").select(
        "FEATURE", "__cur", "__cur_all",
        (F.coalesce("BASE_COUNT", F.lit(0)) / F.greatest("__base", F.lit(1))).alias("__e"),
        (F.coalesce("CUR_COUNT", F.lit(0)) / F.greatest("__cur", F.lit(1))).alias("__a"))
    psi = shares.groupBy("FEATURE").agg(
        F.sum(psi_term(F.col("__e"), F.col("__a"))).alias("__psi"),
        F.first(F.try_divide(F.col("__cur_all") - F.col("__cur"), F.col("__cur_all"))).alias("OUT_OF_RANGE_SHARE"))
    counted = hist.groupBy("FEATURE").agg(F.sum("CUR_COUNT").alias("__n"))
    wanted = spark.createDataFrame([(f,) for f in features], "FEATURE string")
    name = F.col("FEATURE")
    note = (
        F.when(name.isin(lacking["baseline"]), "missing_in_baseline")
        .when(name.isin(lacking["current"]), "missing_in_current")
        .when(F.least(F.coalesce("BASE_N", F.lit(0)), F.coalesce("__n", F.lit(0))) < min_samples,
               "insufficient_samples")
        .when(F.size("EDGES") < 3, "low_variance_baseline"))
    return (
        wanted.join(edges, "FEATURE", "left").join(counted, "FEATURE", "left").join(psi, "FEATURE", "left")
        .withColumn("NOTE", note)
        .withColumn("PSI", F.when(F.col("NOTE").isNull(), F.col("__psi")))
        .select(
            "FEATURE", "PSI", "NOTE",
            F.when(F.col("NOTE").isNull(), F.col("OUT_OF_RANGE_SHARE")).alias("OUT_OF_RANGE_SHARE"),
            step_status(F.col("PSI"), warn, fail, inclusive=True).alias("STATUS"))
    )


def cluster_shares(baseline: DataFrame, current: DataFrame, label_col: str = "CLUSTER_LABEL") -> DataFrame:
    """LABEL, CURRENT_SHARE, BASELINE_SHARE over the labels of either side; a NULL label is a label.

    Counting both sides in one aggregate replaces the full outer join of two histograms.
    """
    sides = baseline.select(F.col(label_col).alias("LABEL"), F.lit(0).alias("__cur")).unionByName(
        current.select(F.col(label_col).alias("LABEL"), F.lit(1).alias("__cur")))
    counts = stage(
        sides.groupBy("LABEL").agg(
            F.count_if(F.col("__cur") == 0).alias("__b"), F.count_if(F.col("__cur") == 1).alias("__c")),
        "label-counts")
    total = counts.agg(F.sum("__b").alias("b"), F.sum("__c").alias("c")).first()
    return counts.select(
        "LABEL",
        (F.col("__c") / F.lit(max(1, total["c"] or 0))).alias("CURRENT_SHARE"),
        (F.col("__b") / F.lit(max(1, total["b"] or 0))).alias("BASELINE_SHARE"))


def cluster_share_kl(shares: DataFrame, warn: float = 0.05, fail: float = 0.10) -> DataFrame:
    """One row: KL (current against baseline), LABELS sorted, STATUS."""
    return shares.agg(
        F.sum(kl_term(F.col("CURRENT_SHARE"), F.col("BASELINE_SHARE"))).alias("KL"),
        F.array_sort(F.collect_list(F.coalesce(F.col("LABEL").cast("string"), F.lit("NULL")))).alias("LABELS"),
    ).withColumn("STATUS", step_status(F.col("KL"), warn, fail, inclusive=True))


def drift_vs_stats(
    current_stats: DataFrame, baseline: DataFrame, mean_warn: float = 0.5, null_fail: float = 0.30,
) -> DataFrame:
    """Mean and null share of the current table (feature_stats rows) against stored statistics.

    A feature missing in the table fails; a baseline mean of 0 counts as no deviation.
    """
    df = _moments(current_stats, baseline)
    status = (
        F.when(~F.col("PRESENT"), "fail")
        .when(F.col("NULL_DELTA") > null_fail, "fail")
        .when(F.col("MEAN_DEV") > mean_warn, "warn")
        .otherwise("ok"))
    return df.withColumn("STATUS", status)


def drift_stats_vs_stats(
    current_stats: DataFrame, baseline: DataFrame, mean_warn: float = 0.25, mean_fail: float = 0.50,
    null_warn: float = 0.10, null_fail: float = 0.30,
) -> DataFrame:
    """The same comparison with a warn and a fail level for both measures."""
    df = _moments(current_stats, baseline)
    rank = F.greatest(
        F.when(~F.col("PRESENT"), 2).otherwise(0),
        status_rank(step_status(F.col("MEAN_DEV"), mean_warn, mean_fail)),
        status_rank(step_status(F.col("NULL_DELTA"), null_warn, null_fail)))
    return df.withColumn("STATUS", status_of_rank(rank))


def _moments(current_stats: DataFrame, baseline: DataFrame) -> DataFrame:
    base, cur = F.col("BASE_MEAN"), F.col("MEAN")
    return baseline.join(current_stats.select("FEATURE", "MEAN", "NULL_PCT"), "FEATURE", "left").select(
        "FEATURE",
        F.col("NULL_PCT").isNotNull().alias("PRESENT"),
        "BASE_MEAN", F.col("MEAN").alias("CURRENT_MEAN"),
        F.when(base == 0, F.when(cur.isNotNull(), 0.0))
        .otherwise(F.abs(cur - base) / (F.abs(base) + 1e-9)).alias("MEAN_DEV"),
        (F.col("NULL_PCT") - F.coalesce("BASE_NULL_PCT", F.lit(0.0))).alias("NULL_DELTA"))


def stats_of_baseline(document: DataFrame) -> DataFrame:
    """Stored statistics in the form of feature_stats rows, to serve as the current side."""
    return document.select("FEATURE", F.col("BASE_MEAN").alias("MEAN"), F.coalesce(
        "BASE_NULL_PCT", F.lit(0.0)).alias("NULL_PCT"))


def drift_status(*reports: DataFrame) -> DataFrame:
    """One row: the worst status over all reports, with the number of warned and failed entries."""
    merged = reports[0].select("STATUS")
    for r in reports[1:]:
        merged = merged.unionByName(r.select("STATUS"))
    return merged.agg(
        status_of_rank(F.coalesce(F.max(status_rank(F.col("STATUS"))), F.lit(0))).alias("STATUS"),
        F.count_if(F.col("STATUS") == "warn").alias("WARNED"),
        F.count_if(F.col("STATUS") == "fail").alias("FAILED"))


def drift_report(
    baseline: DataFrame, current: DataFrame, features: Sequence[str], **thresholds: float,
) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """(feature PSI, KL row or None when a side has no labels, overall status)."""
    psi = drift_psi(
        baseline, current, features, thresholds.get("psi_warn", 0.10), thresholds.get("psi_fail", 0.25))
    if "CLUSTER_LABEL" not in baseline.columns or "CLUSTER_LABEL" not in current.columns:
        return psi, None, drift_status(psi)
    kl = cluster_share_kl(
        cluster_shares(baseline, current), thresholds.get("kl_warn", 0.05), thresholds.get("kl_fail", 0.10))
    return psi, kl, drift_status(psi, kl)
