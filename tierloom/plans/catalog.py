"""Named queries over the test tables, one per operator: name -> f(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.functions.columns import model_key
from tierloom.operators import customers as cust
from tierloom.operators import drift, explain, increments, kernel_shap, kmeans, quality, scaling, scoring, segments, selection
from tierloom.operators import sketches, spend, training
from tierloom.operators import silhouette as measure
from tierloom.operators import silhouette_bounds as bounded_measure
from tierloom.operators.quantiles import long_features
from tierloom.operators.topn import top_n_per_group
from tierloom.plans import fixtures as fx
from tierloom.plans.fixtures import orders_input, rounded
from tierloom.schemas import DEFAULT_FEATURES, SEGMENT_LEVELS, SEGMENT_MODEL
from tierloom.sources import baseline as baselines
from tierloom.sources import bundle, loose_json, sinks, sql_scorer, tables
from tierloom.sources.staging import stage, staged_path

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}


def query(f: Query) -> Query:
    REGISTRY[f.__name__] = f
    return f


def _nullable_int(name):
    """As double, because integers with NULL have no common form in client tables."""
    return F.col(name).cast("double").alias(name)


# Spend tiers and segments


@query
def yearly_spend(spark, sf_dir):
    return rounded(spend.yearly_spend(orders_input(spark, sf_dir)), 4)


@query
def avg_annual_spend(spark, sf_dir):
    return rounded(spend.avg_annual_spend(orders_input(spark, sf_dir)))


@query
def tier_fallback(spark, sf_dir):
    return rounded(spend.customer_profiles(orders_input(spark, sf_dir)).select(
        "CUSTOMER_ID", "TAM", "TIER", "ORDER_ROWS", "AVG_ANNUAL_SPEND", _nullable_int("TIER_NUMERIC"),
        "TAM_TIER_OR_AVGSPEND", "TAM_TIER_SOURCE"))


@query
def null_pct_by_industry(spark, sf_dir):
    return rounded(spend.null_pct_by_industry(spend.customer_profiles(orders_input(spark, sf_dir))))


@query
def spend_thresholds(spark, sf_dir):
    return rounded(spend.spend_thresholds(spend.customer_profiles(orders_input(spark, sf_dir))))


def _binned(spark, sf_dir):
    profiles = stage(spend.customer_profiles(orders_input(spark, sf_dir)), "profiles")
    return spend.tier_bins(profiles, stage(spend.spend_thresholds(profiles), "thresholds"))


@query
def tier_bins(spark, sf_dir):
    return rounded(_binned(spark, sf_dir).select(
        "CUSTOMER_ID", "INDUSTRY_CODE_DESC", "TAM_TIER_SOURCE", "TAM_TIER_OR_AVGSPEND", "value_q1", "value_q2",
        "value_q3", "TAM_TIER_BIN"))


@query
def segment_keys(spark, sf_dir):
    return segments.segment_keys(_binned(spark, sf_dir)).select("CUSTOMER_ID", *SEGMENT_LEVELS)


@query
def segment_counts(spark, sf_dir):
    return segments.segment_counts(segments.segment_keys(_binned(spark, sf_dir)))


@query
def segment_counts_bitmap(spark, sf_dir):
    """segment_counts from the bitmaps of two parts of the rows, stored apart and merged."""
    keyed = segments.segment_keys(_binned(spark, sf_dir))
    half = F.pmod(F.xxhash64("CUSTOMER_ID", "MSA"), F.lit(2))
    parts = [stage(increments.customer_bitmaps(keyed.where(half == i)), "segment-bitmaps") for i in (0, 1)]
    return increments.bitmap_counts(increments.merge_bitmaps(*parts))


@query
def avg_annual_spend_incremental(spark, sf_dir):
    """avg_annual_spend from a first load and two deltas."""
    orders = orders_input(spark, sf_dir)
    loads = [orders.where(F.pmod(F.col("ORDER_ID"), F.lit(5)).isin(*part)) for part in ((0, 1, 2), (3,), (4,))]
    state = stage(increments.spend_state(loads[0]), "spend-state")
    averages = stage(increments.average_spend(state), "spend-averages")
    for delta in loads[1:]:
        state, averages = (stage(t, "spend-state") for t in increments.apply_orders(state, averages, delta))
    return rounded(averages)


def _segmented(spark, sf_dir):
    return segments.segment_profiles(orders_input(spark, sf_dir), fx.MIN_SEGMENT_SIZE)


@query
def segment_assign(spark, sf_dir):
    return _segmented(spark, sf_dir).groupBy("SEGMENT", "SEGMENT_LEVEL").agg(
        F.countDistinct("CUSTOMER_ID").alias("CUSTOMERS"), F.sum("ORDER_ROWS").alias("ORDER_ROWS"))


@query
def prepared_orders(spark, sf_dir):
    profiles = stage(_segmented(spark, sf_dir), "segmented")
    return rounded(segments.prepare_orders(orders_input(spark, sf_dir), profiles).select(
        "ORDER_ID", "CUSTOMER_ID", "ORDER_YEAR", "GSAR", "AVG_ANNUAL_SPEND", _nullable_int("TIER_NUMERIC"),
        "TAM_TIER_OR_AVGSPEND", "TAM_TIER_SOURCE", "TAM_TIER_BIN", "COUNT_SEG_1", "COUNT_SEG_2", "COUNT_SEG_3", "SEGMENT"))


# Scans, customer grain, data quality


@query
def extract_window(spark, sf_dir):
    rows = tables.extract_window(
        orders_input(spark, sf_dir), "ORDER_ID", start_date="1996-01-01", end_date="1998-01-01")
    return rounded(rows.select("ORDER_ID", "CUSTOMER_ID", "GSAR"))


@query
def normalized_scan(spark, sf_dir):
    return rounded(tables.normalized_scan(fx.table(spark, sf_dir, "customer")))


@query
def sample_scan(spark, sf_dir):
    return rounded(tables.sample_scan(
        orders_input(spark, sf_dir), ["ORDER_ID", "CUSTOMER_ID", "GSAR", "TIER"], "ORDER_ID", limit=1000))


@query
def dq_check(spark, sf_dir):
    columns = ["CUSTOMER_ID", "ORDER_DATE", "GSAR", "INDUSTRY_CODE_DESC", "MSA", "TAM", "TIER", "LIFETIME_VALUE"]
    return rounded(quality.dq_check(orders_input(spark, sf_dir), columns, min_rows=100))


@query
def customer_features(spark, sf_dir):
    return rounded(fx.customers(orders_input(spark, sf_dir)))


TRAIN_FEATURES = ["RECENCY_DAYS", "ORDER_FREQUENCY", "AVG_ORDER_VALUE", "TAM"]
TRAIN_INDUSTRIES = ["Building", "AUTOMOBILE", "machinery"]


def _training_rows(spark, sf_dir, features=DEFAULT_FEATURES, industries=()):
    return cust.training_rows(
        fx.customers(orders_input(spark, sf_dir)), features, industries, segment_col=fx.COARSE)


@query
def train_input(spark, sf_dir):
    """The industry filter and the rows dropped for a missing feature are what this query shows."""
    return rounded(cust.train_input(_training_rows(spark, sf_dir, TRAIN_FEATURES, TRAIN_INDUSTRIES), TRAIN_FEATURES))


@query
def train_cap(spark, sf_dir):
    return cust.cap_per_industry(_training_rows(spark, sf_dir), max_rows=50).select(
        "CUSTOMER_ID", "INDUSTRY", "SEGMENT", "USABLE")


# The sketch is exact for groups of up to some ten thousand rows at this accuracy (sf0.01); beyond that p1 and p99
# may be one rank off.
STATS_ACCURACY = 100_000


def _stats_and_baseline(spark, sf_dir):
    earlier, later = fx.drift_halves(orders_input(spark, sf_dir))
    names = ["GSAR", "TAM", "TIER_NUMERIC"]
    document = baselines.baseline_document(quality.feature_stats(earlier, names, STATS_ACCURACY))
    path = staged_path(spark, "baseline-json")
    document.write.text(path)
    stored = baselines.read_baseline(spark, path).select(
        "FEATURE", "BASE_P1", "BASE_P99", "BASE_MEAN", "BASE_NULL_PCT")
    absent = spark.createDataFrame([("LIFETIME_VALUE", 0.0, 9.0, 1.0, 0.0)], stored.schema)
    return later, names, stage(stored.unionByName(absent), "baseline")


def _checked(spark, sf_dir):
    later, names, stored = _stats_and_baseline(spark, sf_dir)
    overrides = baselines.flex_overrides(spark, '{"TIER_NUMERIC": {"flex_pct": 0.2}, "TAM": {"flex": 0.4}}')
    return later, names, quality.feature_check(quality.feature_stats(later, names, STATS_ACCURACY), stored, overrides)


@query
def baseline_coverage(spark, sf_dir):
    later, _, stored = _stats_and_baseline(spark, sf_dir)
    return quality.baseline_coverage(stored, later)


@query
def feature_stats(spark, sf_dir):
    rows = fx.drift_columns(orders_input(spark, sf_dir))
    return rounded(quality.feature_stats(rows, fx.DRIFT_FEATURES, STATS_ACCURACY))


SKETCH_RANKS = [0.01, *[i / 10 for i in range(1, 10)], 0.99]


@query
def merged_sketches(spark, sf_dir):
    """Statistics of all runs (a run a year) from their stored sketches, and whether every quantile's true rank is within
    the stated error."""
    rows = fx.drift_columns(orders_input(spark, sf_dir)).withColumn("YEAR", F.year("ORDER_DATE"))
    stored = stage(sketches.run_sketches(rows, "YEAR", fx.DRIFT_FEATURES), "run-sketches")
    every = stage(sketches.merged(stored), "merged-sketches")
    found = sketches.quantiles(every, SKETCH_RANKS).select(
        "FEATURE", F.posexplode("Q").alias("AT", "Q")).withColumn("P", F.get(F.array(*map(F.lit, SKETCH_RANKS)), F.col("AT")))
    error = F.lit(sketches.rank_error())
    ranks = sketches.true_ranks(long_features(rows, [], fx.DRIFT_FEATURES), stage(found, "sketch-quantiles")).groupBy("FEATURE").agg(
        F.min((F.col("LOW") - error <= F.col("P")) & (F.col("P") <= F.col("HIGH") + error)).alias("WITHIN"))
    return rounded(sketches.merged_stats(every).join(ranks, "FEATURE").select("FEATURE", "TOTAL_ROWS", "MEAN", "NULL_PCT", "WITHIN"))


@query
def baseline_documents(spark, sf_dir):
    """Baselines of unknown shape: a plain one, one below another key with more keys, a cut one, one without features."""
    earlier, _ = fx.drift_halves(orders_input(spark, sf_dir))
    plain = baselines.baseline_document(quality.feature_stats(earlier, ["GSAR", "TAM", "TIER_NUMERIC"], STATS_ACCURACY))
    nested = F.concat(F.lit('{"version": 2, "features": '), F.replace("value", F.lit('"p1"'), F.lit('"unit": {"name": "x"}, "rank": "high", "p1"')), F.lit("}"))
    documents = stage(plain.select(F.posexplode(F.array(
        F.col("value"), nested, F.substring("value", 1, 30), F.lit('{"a": [1, {"b": null}], "c": "text"}'))).alias("DOCUMENT", "value")), "documents")
    found = loose_json.baseline_rows(documents)
    return rounded(found.withColumn("EXTRA", F.array_join(F.array_sort(F.map_keys("EXTRA")), ",")))


@query
def feature_check(spark, sf_dir):
    return rounded(_checked(spark, sf_dir)[2].withColumn("TOTAL_ROWS", F.col("TOTAL_ROWS").cast("double")))


@query
def feature_gate(spark, sf_dir):
    return quality.feature_gate(_checked(spark, sf_dir)[2])


@query
def failing_rows(spark, sf_dir):
    later, names, checks = _checked(spark, sf_dir)
    return rounded(quality.failing_rows(later, checks, names, "ORDER_ID", max_rows=10).select(
        "FEATURE", "FEATURE_VALUE", "ORDER_ID", "CUSTOMER_ID", "TAM", _nullable_int("TIER_NUMERIC")))


# Scaling, models, scoring


def _fixed(spark, sf_dir):
    customers = stage(fx.customers(orders_input(spark, sf_dir)), "customers")
    return customers, fx.FixedModels(customers)


@query
def robust_scaler(spark, sf_dir):
    rows = stage(cust.train_input(_training_rows(spark, sf_dir)), "train")
    return rounded(scaling.robust_scaler_rows(rows, DEFAULT_FEATURES))


@query
def scaled_features(spark, sf_dir):
    rows = stage(cust.train_input(_training_rows(spark, sf_dir)), "train")
    scaler = stage(scaling.robust_scaler(rows, DEFAULT_FEATURES), "scaler")
    z = scaling.scaled_rows(rows, scaler, DEFAULT_FEATURES)
    return rounded(z.select(
        "CUSTOMER_ID", "SEGMENT_KEY", *[F.col("Z")[j].alias(f"Z_{f}") for j, f in enumerate(DEFAULT_FEATURES)]))


@query
def k_candidates(spark, sf_dir):
    rows = cust.training_rows(fx.customers(orders_input(spark, sf_dir)), segment_col=fx.COARSE)
    return cust.explode_k(cust.k_candidates(cust.segment_sizes(rows), 2, 10)).select(
        "SEGMENT_KEY", "USABLE_COUNT", "K")


@query
def segment_status(spark, sf_dir):
    rows = cust.training_rows(fx.customers(orders_input(spark, sf_dir)), TRAIN_FEATURES, segment_col=fx.COARSE)
    return cust.readiness(cust.segment_sizes(rows), fx.MIN_CUSTOMERS, False, 2, 10).select(
        "SEGMENT_KEY", "CUSTOMER_COUNT", "USABLE_COUNT", "K_LO", "K_HI", "STATUS")


@query
def model_resolve(spark, sf_dir):
    _, fixed = _fixed(spark, sf_dir)
    folder = staged_path(spark, "bundle-json")
    bundle.export_json(fixed.model_of_k(3), folder, 2, 4, fx.MIN_CUSTOMERS)
    models = bundle.import_json(spark, folder, segments="segments", multi_line=False)
    return rounded(bundle.centroid_rows(models))


@query
def latest_run(spark, sf_dir):
    """One run per order year, each holding the customer count of every segment active in that year."""
    orders = orders_input(spark, sf_dir).where("CUSTOMER_ID IS NOT NULL")
    key = model_key(F.col("INDUSTRY_CODE_DESC"), F.col("COMPANY_TYPE_DESC"))
    runs = orders.groupBy(
        F.concat(F.lit("run_"), F.year("ORDER_DATE").cast("string")).alias("run_id"), key.alias("segment_key"),
    ).agg(F.countDistinct("CUSTOMER_ID").alias("customer_count"))
    filled = runs.select(*[
        F.col(f.name) if f.name in runs.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in SEGMENT_MODEL])
    root = staged_path(spark, "bundle")
    bundle.write_bundle(filled, root)
    return bundle.open_run(spark, root, "latest").select("run_id", "segment_key", "customer_count")


@query
def score_segments(spark, sf_dir):
    """One feature comes as text, as client tables have it."""
    customers, fixed = _fixed(spark, sf_dir)
    customers = customers.withColumn("ORDER_FREQUENCY", F.col("ORDER_FREQUENCY").cast("string"))
    return scoring.score_segments(
        customers, fixed.model_of_k(4), fx.RUN_ID, "2001-08-01T00:00:00Z", segment_col=fx.COARSE)


@query
def score_by_key(spark, sf_dir):
    customers, fixed = _fixed(spark, sf_dir)
    return scoring.score_by_key(customers, fixed.model_of_k(3), segment_col=fx.COARSE)


@query
def score_by_sql(spark, sf_dir):
    """score_by_key by a SQL function made from the models."""
    customers, fixed = _fixed(spark, sf_dir)
    name = f"assign_cluster_{uuid.uuid4().hex}"
    sql_scorer.register(spark, fixed.model_of_k(3), DEFAULT_FEATURES, name)
    key = model_key(F.col("MOST_RECENT_INDUSTRY_CODE_DESC"), F.col(fx.COARSE))
    return customers.withColumn("SEGMENT_KEY", key).selectExpr(
        "CUSTOMER_ID", "SEGMENT_KEY", f"{name}(SEGMENT_KEY, {', '.join(DEFAULT_FEATURES)}) as CLUSTER_LABEL")


@query
def score_global(spark, sf_dir):
    customers = stage(fx.customers(orders_input(spark, sf_dir)), "customers")
    feats = fx.GLOBAL_FEATURES
    complete = customers.where("TAM IS NOT NULL").withColumn("SEGMENT_KEY", F.lit("ALL"))
    scaler = stage(scaling.robust_scaler(complete, feats), "scaler")
    first = top_n_per_group(
        scaling.scaled_rows(complete, scaler, feats), ["SEGMENT_KEY"], [F.col("CUSTOMER_ID")], 3, rank_col="NO")
    model = first.groupBy("SEGMENT_KEY").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("NO", "Z"))), lambda s: s["Z"]).alias("centroids"),
    ).join(scaler, "SEGMENT_KEY").select(
        F.array(*[F.lit(f) for f in feats]).alias("features"), F.col("CENTER").alias("center"),
        F.col("SCALE").alias("scale"), "centroids")
    scored = scoring.score_global(customers, model, fx.RUN_ID, "2001-08-01T00:00:00Z")
    return rounded(scored.select("CUSTOMER_ID", *feats, "CLUSTER_LABEL", "RUNID"))


@query
def silhouette(spark, sf_dir):
    return rounded(_fixed(spark, sf_dir)[1].scores())


BOUNDS_OPENNESS = 0.25


@query
def silhouette_bounds(spark, sf_dir):
    """Whether the certified bounds hold the exact value and are as narrow as the openness promises."""
    fixed = _fixed(spark, sf_dir)[1]
    labelled = stage(kmeans.label_points(fixed.points, fixed.models, len(DEFAULT_FEATURES)), "labelled-points")
    bounds = bounded_measure.silhouette_bounds(labelled, BOUNDS_OPENNESS)
    # Every sum is off by a factor of root(1 + openness^2) at most.
    most = math.sqrt(1 + BOUNDS_OPENNESS ** 2)
    return rounded(fixed.scores().join(bounds, ["SEGMENT_KEY", "K"]).select(
        "SEGMENT_KEY", "K", "SILHOUETTE", F.col("SILHOUETTE").between(F.col("LOWER"), F.col("UPPER")).alias("HOLDS"),
        (F.col("UPPER") - F.col("LOWER") <= most - 1 / most + 1e-8).alias("NARROW")))


@query
def best_k(spark, sf_dir):
    return rounded(selection.best_k(_fixed(spark, sf_dir)[1].scores()))


@query
def lloyd_step(spark, sf_dir):
    fixed = _fixed(spark, sf_dir)[1]
    sums = kmeans.cluster_sums(
        kmeans.assign(fixed.points, fixed.models, len(DEFAULT_FEATURES), max(fx.FIXED_KS)), len(DEFAULT_FEATURES))
    return rounded(sums.select(
        "SEGMENT_KEY", "K", "LABEL", "N", "INERTIA",
        *[F.col("MEAN")[j].alias(f"C_{f}") for j, f in enumerate(DEFAULT_FEATURES)]), 5)


def _runs_by_industry(spark, sf_dir):
    """The fixed models as one run per industry, so that the gate has several runs to judge."""
    table = _fixed(spark, sf_dir)[1].model_table()
    return table.withColumn("run_id", F.concat(F.lit("run_"), F.replace(F.col("industry"), F.lit(" "), F.lit("_"))))


GATE_THRESHOLD = 0.20


@query
def model_gate(spark, sf_dir):
    return rounded(selection.model_gate(_runs_by_industry(spark, sf_dir), GATE_THRESHOLD))


@query
def accepted_models(spark, sf_dir):
    gate = selection.model_gate(_runs_by_industry(spark, sf_dir), GATE_THRESHOLD)
    return rounded(selection.accepted_models(gate, "segment-clusters", "models", '{"stage":"test"}', "fixed centroids"))


def _training_options(**changes):
    """The defaults: 2 to 10 clusters, 10 restarts, 300 rounds, mini-batches of 1,024 above 20,000 rows."""
    return training.TrainingOptions(segment_col=fx.COARSE, min_customers=fx.MIN_CUSTOMERS, **changes)


def _fitted(spark, sf_dir, **changes):
    customers = stage(fx.customers(orders_input(spark, sf_dir)), "customers")
    return training.fit_segments(customers, _training_options(**changes))


@query
def kmeans_fit(spark, sf_dir):
    fitted = _fitted(spark, sf_dir).models
    return rounded(fitted.select("SEGMENT_KEY", "K", "RESTART", "INERTIA", "ITERATIONS"))


@query
def kmeans_check(spark, sf_dir):
    """Every fitted model judged by one exact step over all points."""
    opts = _training_options()
    trained = _fitted(spark, sf_dir)
    return kmeans.check(trained.points, trained.models, len(opts.features), opts.tol)


@query
def kmeans_minibatch(spark, sf_dir):
    """All segments by mini-batches, as if they were large."""
    fitted = _fitted(spark, sf_dir, mini_batch_over=0).models
    return rounded(fitted.select("SEGMENT_KEY", "K", "RESTART", "INERTIA", "ITERATIONS"))


@query
def model_manifest(spark, sf_dir):
    customers = stage(fx.customers(orders_input(spark, sf_dir)), "customers")
    models = training.train(customers, "run_trained", fx.RUN_STAMP, _training_options())
    root = staged_path(spark, "bundle")
    bundle.write_bundle(models, root)
    return rounded(bundle.open_run(spark, root).select(
        "run_id", "segment_key", "status", "customer_count", "best_k", "best_silhouette"))


# Drift


def _halves(spark, sf_dir):
    return fx.drift_halves(orders_input(spark, sf_dir))


@query
def drift_edges(spark, sf_dir):
    edges = drift.drift_edges(_halves(spark, sf_dir)[0], fx.DRIFT_FEATURES)
    return rounded(edges.select("FEATURE", "BASE_N", F.posexplode("EDGES").alias("EDGE_NO", "EDGE")))


@query
def drift_hist(spark, sf_dir):
    before, after = _halves(spark, sf_dir)
    edges = stage(drift.drift_edges(before, fx.DRIFT_FEATURES), "drift-edges")
    hist = drift.drift_hist(before, after, fx.DRIFT_FEATURES, edges)
    return hist.withColumn("BIN", F.coalesce("BIN", F.lit(-1)))


@query
def drift_psi(spark, sf_dir):
    before, after = _halves(spark, sf_dir)
    return rounded(drift.drift_psi(before, after, fx.DRIFT_FEATURES))


def _shares(spark, sf_dir):
    """Label shares of the customers of either half under the fixed models of all customers."""
    _, fixed = _fixed(spark, sf_dir)
    models = fixed.model_of_k(3)
    sides = [scoring.score_segments(
        fx.customers(half), models, fx.RUN_ID, "", segment_col=fx.COARSE) for half in _halves(spark, sf_dir)]
    return drift.cluster_shares(*sides)


@query
def cluster_shares(spark, sf_dir):
    return rounded(_shares(spark, sf_dir))


@query
def cluster_share_kl(spark, sf_dir):
    return rounded(drift.cluster_share_kl(_shares(spark, sf_dir)).withColumn(
        "LABELS", F.array_join("LABELS", ",")))


@query
def drift_vs_stats(spark, sf_dir):
    later, names, stored = _stats_and_baseline(spark, sf_dir)
    return rounded(drift.drift_vs_stats(quality.feature_stats(later, names, STATS_ACCURACY), stored))


@query
def drift_stats_vs_stats(spark, sf_dir):
    later, names, stored = _stats_and_baseline(spark, sf_dir)
    return rounded(drift.drift_stats_vs_stats(quality.feature_stats(later, names, STATS_ACCURACY), stored))


@query
def drift_status(spark, sf_dir):
    before, after = _halves(spark, sf_dir)
    return drift.drift_status(
        drift.drift_psi(before, after, fx.DRIFT_FEATURES), drift.cluster_share_kl(_shares(spark, sf_dir)))


# Writers and inferred columns


@query
def run_sink(spark, sf_dir):
    """Orders of each priority written as a run, one of them twice, and read back."""
    orders, path = fx.table(spark, sf_dir, "orders"), staged_path(spark, "runs")
    for name in ("RUN A/1", "other", "RUN A/1"):
        urgent = F.col("o_orderpriority") == "1-URGENT"
        rows = orders.where(urgent if name != "other" else ~urgent).select("o_orderkey", "o_totalprice")
        sinks.write_run(rows, path, name)
    return rounded(spark.read.parquet(path).groupBy("RUN_ID").agg(
        F.count(F.lit(1)).alias("ROW_COUNT"), F.sum(F.col("o_totalprice").cast("decimal(38,2)")).cast("double").alias("TOTAL")), 2)


@query
def overwrite_sink(spark, sf_dir):
    """The row counts that writers observe, for a path that is written again and for one that grows."""
    orders, path = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), staged_path(spark, "rows")
    first = sinks.overwrite_path(orders, f"{path}/replaced")
    second = sinks.overwrite_path(orders.where("o_custkey % 2 = 0"), f"{path}/replaced")
    added = sinks.append_rows(orders, f"{path}/grown") + sinks.append_rows(orders, f"{path}/grown")
    seen = spark.createDataFrame([(first, second, added)], "FIRST_ROWS long, SECOND_ROWS long, ADDED_ROWS long")
    tables_read = (sinks.read_path(spark, f"{path}/replaced"), "REPLACED"), (spark.read.parquet(f"{path}/grown"), "GROWN")
    kept = [rows.agg(F.count(F.lit(1)).alias(column)) for rows, column in tables_read]
    return seen.join(F.broadcast(kept[0])).join(F.broadcast(kept[1]))  # one row each


@query
def report_sink(spark, sf_dir):
    """The data-quality report as JSON lines, read back."""
    root = staged_path(spark, "reports")
    path = sinks.write_report(
        quality.dq_check(orders_input(spark, sf_dir), ["GSAR", "TAM", "TIER"]), root, "data_quality", "run-1")
    return rounded(spark.read.schema("COLUMN_NAME string, NULL_RATE double, STATUS string, TOTAL_ROWS long").json(path))


@query
def explanation_records(spark, sf_dir):
    """Explanations of a run as JSON records in a folder per segment, read back."""
    labelled, models = _explained(spark, sf_dir)
    shap = explain.cluster_shap(labelled, models, DEFAULT_FEATURES, fx.RUN_ID, fx.RUN_STAMP)
    root = staged_path(spark, "explanations")
    sinks.write_explanations(shap, root)
    kind = "CLUSTER int, CLUSTER_SHAP map<string, double>, RUNID string, SEGMENT string"
    return spark.read.schema(kind).json(root).select(
        "SEGMENT", "CLUSTER", F.size("CLUSTER_SHAP").alias("FEATURES"), "RUNID")


@query
def inferred_columns(spark, sf_dir):
    """Statistics of the columns found numeric: all of them, and those an explanation uses."""
    customers = fx.customers(orders_input(spark, sf_dir)).withColumn("CLUSTER_LABEL", F.lit(0))
    found = tables.numeric_columns(customers)
    used = set(tables.explanation_columns(customers))
    rows = stage(customers.select(*[F.col(c).cast("double").alias(c) for c in found]), "numeric")
    return rounded(quality.feature_stats(rows, found, STATS_ACCURACY).select(
        "FEATURE", F.col("FEATURE").isin(*used).alias("EXPLAINS"), "TOTAL_ROWS", "NULL_PCT"))


# Explanation


@query
def segment_prefix(spark, sf_dir):
    models = _fixed(spark, sf_dir)[1].model_of_k(3)
    return explain.select_segments(models, "Auto").select("segment_key", "status", "customer_count")


def _explained(spark, sf_dir):
    customers, fixed = _fixed(spark, sf_dir)
    models = fixed.model_of_k(3)
    return stage(explain.scaled_labelled(customers, models, segment_col=fx.COARSE), "labelled"), models


@query
def cluster_shap(spark, sf_dir):
    labelled, models = _explained(spark, sf_dir)
    shap = explain.cluster_shap(labelled, models, DEFAULT_FEATURES, fx.RUN_ID, fx.RUN_STAMP)
    return rounded(shap.select(
        "SEGMENT", "CLUSTER", F.explode("CLUSTER_SHAP").alias("FEATURE", "SHAP"), "RUNID", "RUNTIMESTAMP"), 5)


@query
def cluster_shap_sampled(spark, sf_dir):
    """cluster_shap against a quarter of the rows, for at most 20 rows of a segment."""
    labelled, models = _explained(spark, sf_dir)
    shap = explain.cluster_shap(labelled, models, DEFAULT_FEATURES, fx.RUN_ID, fx.RUN_STAMP, background_fraction=0.25, max_rows=20)
    return rounded(shap.select("SEGMENT", "CLUSTER", F.explode("CLUSTER_SHAP").alias("FEATURE", "SHAP")), 5)


@query
def cluster_shap_tables(spark, sf_dir):
    """Models of one industry name a table of their own, two columns, and a target table."""
    customers, fixed = _fixed(spark, sf_dir)
    path = staged_path(spark, "own-customers")
    customers.where("CUSTOMER_ID % 2 = 0").write.parquet(path)
    special = F.col("segment_key").startswith("AUTO")
    models = stage(fixed.model_of_k(3).withColumns({
        "input_table": F.when(special, path), "x_cols": F.when(special, F.array(*map(F.lit, DEFAULT_FEATURES[:2]))),
        "output_table": F.when(special, "auto_shap")}), "named-models")
    shap = explain.explain_models(customers, models, fx.RUN_ID, fx.RUN_STAMP, segment_col=fx.COARSE)
    return rounded(shap.select("SEGMENT", "CLUSTER", F.explode("CLUSTER_SHAP").alias("FEATURE", "SHAP"), "TARGET"), 5)


@query
def cluster_shap_kernel(spark, sf_dir):
    """KernelSHAP of the distance to the own centre against 50 rows of a segment."""
    labelled, models = _explained(spark, sf_dir)
    shap = kernel_shap.kernel_shap(labelled, models, DEFAULT_FEATURES, fx.RUN_ID, fx.RUN_STAMP, background_rows=50)
    each = F.explode(F.arrays_zip(F.map_keys("CLUSTER_SHAP").alias("FEATURE"), F.map_values("CLUSTER_SHAP").alias("SHAP"), F.map_values("CLUSTER_MEAN").alias("MEAN_SHAP")))
    return rounded(shap.select("SEGMENT", "CLUSTER", each.alias("x")).select("SEGMENT", "CLUSTER", "x.FEATURE", "x.SHAP", "x.MEAN_SHAP"), 4)


@query
def cluster_shap_margin(spark, sf_dir):
    """KernelSHAP of a score that is not additive: whether the mean contributions add up to the gain over the background."""
    labelled, models = _explained(spark, sf_dir)
    shap = kernel_shap.kernel_shap(
        labelled, models, DEFAULT_FEATURES, fx.RUN_ID, fx.RUN_STAMP, kernel_shap.margin, background_rows=20, max_rows=50)
    total = F.aggregate(F.map_values("CLUSTER_MEAN"), F.lit(0.0), lambda a, x: a + x)
    return shap.select("SEGMENT", "CLUSTER", (F.abs(total - F.col("FULL") + F.col("BASE")) < 1e-6 * (1 + F.abs("FULL"))).alias("ADDS_UP"))


@query
def silhouette_embeddings(spark, sf_dir):
    """Silhouette of the given labels on dense vectors with many entries."""
    embeddings = fx.table(spark, sf_dir, "embeddings")
    labels = embeddings.agg(F.max("label")).first()[0] + 1
    vectors = embeddings.select(
        F.lit("ALL").alias("SEGMENT_KEY"), F.col("embedding").cast("array<double>").alias("Z"),
        F.array(F.lit(labels)).alias("KS"), F.array("label").alias("LABELS"))
    points = vectors.groupBy("SEGMENT_KEY", "Z", "KS", "LABELS").agg(F.count(F.lit(1)).alias("W"))
    return rounded(measure.silhouette(points))


@query
def cluster_shap_label(spark, sf_dir):
    labelled, models = _explained(spark, sf_dir)
    shap = explain.cluster_shap_label(labelled, models, DEFAULT_FEATURES, fx.RUN_ID, fx.RUN_STAMP)
    return rounded(shap.select("SEGMENT", "CLUSTER", F.explode("CLUSTER_SHAP").alias("FEATURE", "SHAP")))
