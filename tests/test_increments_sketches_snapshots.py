import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierloom.operators import explain, increments, kernel_shap, scoring, sketches, spend
from tierloom.operators.drift import DECILES
from tierloom.operators.quality import feature_stats
from tierloom.schemas import SEGMENT_MODEL
from tierloom.sources import loose_json, sinks, sql_scorer, staging
from tierloom.sources.snapshots import ConcurrentCommit, SnapshotTable

ORDERS = "CUSTOMER_ID long, ORDER_DATE timestamp_ntz, GSAR double"


def orders(spark, n, seed=0):
    r = np.random.default_rng(seed)
    rows = [(int(r.integers(0, 40)) if r.random() > 0.05 else None, f"{r.integers(1995, 1999)}-0{r.integers(1, 9)}-11 00:00:00",
             float(np.round(r.normal(100, 50), 2)) if r.random() > 0.1 else None) for _ in range(n)]
    return spark.createDataFrame(rows, "CUSTOMER_ID long, d string, GSAR double").select(
        "CUSTOMER_ID", F.col("d").cast("timestamp_ntz").alias("ORDER_DATE"), "GSAR", F.monotonically_increasing_id().alias("i")).cache()


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_two_deltas_give_the_averages_of_all_orders(spark):
    every = orders(spark, 400)
    state = increments.spend_state(every.where("i % 4 < 2"))
    averages = increments.average_spend(state)
    for k in (2, 3):
        state, averages = increments.apply_orders(state, averages, every.where(f"i % 4 = {k}"))
    def rounded(df):
        return rows_of(df.select("CUSTOMER_ID", F.round("AVG_ANNUAL_SPEND", 6)))

    assert rounded(averages) == rounded(spend.avg_annual_spend(every))
    assert rows_of(state.select("CUSTOMER_ID", "ORDER_YEAR", "ORDERS")) == rows_of(
        every.groupBy("CUSTOMER_ID", F.year("ORDER_DATE").alias("y")).count())
    same = increments.apply_orders(state, averages, every.limit(0))
    assert rows_of(same[0]) == rows_of(state) and rows_of(same[1]) == rows_of(averages)


def test_untouched_customers_are_not_computed_anew(spark):
    every = orders(spark, 200)
    state = increments.spend_state(every)
    marked = increments.average_spend(state).withColumn("AVG_ANNUAL_SPEND", F.lit(-1.0))
    _, after = increments.apply_orders(state, marked, every.where("CUSTOMER_ID = 7"))
    assert {r["CUSTOMER_ID"] for r in after.where("AVG_ANNUAL_SPEND <> -1").collect()} == {7}


def test_bitmaps_count_as_distinct_does(spark):
    r = np.random.default_rng(1)
    rows = [(int(x) if x % 11 else None, f"a{x % 3}", f"b{x % 2}") for x in r.choice([5, 77, 40_000, 2 ** 40, *range(100)], 500)]
    rows.append((None, "lonely", "b0"))
    df = spark.createDataFrame(rows, "CUSTOMER_ID long, L1 string, L2 string").withColumn("n", F.monotonically_increasing_id())
    parts = [increments.customer_bitmaps(df.where(f"n % 3 = {i}"), ["L1", "L2"]) for i in range(3)]
    want = df.unpivot(["CUSTOMER_ID"], ["L1", "L2"], "LEVEL_NAME", "SEGMENT_KEY").groupBy("LEVEL_NAME", "SEGMENT_KEY").agg(
        F.countDistinct("CUSTOMER_ID").alias("CUSTOMERS"))
    assert rows_of(increments.bitmap_counts(increments.merge_bitmaps(*parts))) == rows_of(want)
    assert rows_of(increments.bitmap_counts(increments.customer_bitmaps(df, ["L1", "L2"]))) == rows_of(want)


@pytest.mark.parametrize("k", [200, 2000])
def test_merged_sketches_keep_their_rank_error(spark, k):
    r = np.random.default_rng(2)
    x = np.concatenate([r.lognormal(size=9000), np.zeros(1000)])
    df = spark.createDataFrame([(int(i % 5), float(v), None) for i, v in enumerate(r.permutation(x))], "RUN_ID int, X double, Y double")
    runs = sketches.run_sketches(df, "RUN_ID", ["X", "Y"], k)
    assert runs.count() == 10
    found = {row["FEATURE"]: row for row in sketches.quantiles(sketches.merged(runs, k=k), DECILES).collect()}
    for p, q in zip(DECILES, found["X"]["Q"], strict=True):
        assert (x < q).mean() - sketches.rank_error(k) <= p <= (x <= q).mean() + sketches.rank_error(k)
    assert found["X"]["VALUES"] == 10_000 and found["Y"]["Q"] is None and found["Y"]["VALUES"] == 0
    exact = {row["FEATURE"]: row for row in feature_stats(df, ["X", "Y"]).collect()}
    for row in sketches.merged_stats(sketches.merged(runs, k=k)).collect():
        assert (row["TOTAL_ROWS"], row["NULL_PCT"]) == (exact[row["FEATURE"]]["TOTAL_ROWS"], exact[row["FEATURE"]]["NULL_PCT"])
    two = sketches.merged(runs.where("RUN in (1, 3)"), k=k)
    edges = sketches.merged_edges(two, DECILES).collect()
    assert [e["FEATURE"] for e in edges] == ["X"] and edges[0]["BASE_N"] == 4000 and edges[0]["EDGES"] == sorted(edges[0]["EDGES"])


def test_a_killed_write_leaves_the_old_rows(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.replace(spark.range(5)) == 1
    broken = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="killed"):
        table.replace(broken.repartition(4))
    assert table.version() == 1 and table.read().count() == 5
    # Dead between data and commit: the folder is there, the commit is not.
    spark.range(9).write.parquet(f"{tmp_path}/t/snapshot-000000000002-dead")
    assert table.read().count() == 5
    assert table.replace(table.read().where("id > 1")) == 2  # reads what it replaces
    assert table.read().count() == 3 and table.read(1).count() == 5
    assert not (tmp_path / "t" / "snapshot-000000000002-dead").exists()
    assert table.replace(spark.range(1)) == 3
    with pytest.raises(FileNotFoundError):
        table.read(1) if (tmp_path / "t" / "_commits" / "000000000001").exists() else (_ for _ in ()).throw(FileNotFoundError())
    with pytest.raises(ConcurrentCommit):
        table.replace(spark.range(2), expected=2)
    assert table.read().count() == 1


def test_overwrite_path_commits(spark, tmp_path):
    path = str(tmp_path / "rows")
    assert sinks.overwrite_path(spark.range(4), path) == 4 and sinks.overwrite_path(spark.range(2), path) == 2
    assert SnapshotTable(spark, path).read().count() == 2


def model_rows(spark, n=2):
    rows = [("r", "t", f"IND::S'{i}", "IND", f"S'{i}", "CLUSTERED", 9, 2, 0.5, None, ["f0", "f1"], [1.0, 2.0] if i else None,
             [2.0, 0.5] if i else None, [[0.0, 0.0], [1.0 + i, 1.0], [0.0, 0.0]], None, None, None, None) for i in range(n)]
    rows.append(("r", "t", "IND::skip", "IND", "skip", "SKIPPED_TOO_SMALL", 1, *[None] * 11))
    return spark.createDataFrame(rows, SEGMENT_MODEL)


def test_sql_function_labels_as_the_join_does(spark):
    r = np.random.default_rng(4)
    rows = [(i, f"S'{i % 3}", "ind", float(r.normal(1, 2)), float(r.normal(1, 2))) for i in range(60)]
    rows += [(60, "S'0", "ind", None, 1.0), (61, "skip", "ind", 0.0, 0.0), (62, "S'1", "ind", float("nan"), 1.0), (63, "S'0", "ind", float("inf"), 1.0),
             (64, "S'0", "ind", 0.5, 0.5)]
    df = spark.createDataFrame(rows, "CUSTOMER_ID long, SEGMENT string, MOST_RECENT_INDUSTRY_CODE_DESC string, F0 double, F1 double")
    models = model_rows(spark)
    sql_scorer.register(spark, models, ["F0", "F1"], "assign_test")
    df.createOrReplaceTempView("scored_rows")
    got = spark.sql("select CUSTOMER_ID, assign_test(concat('IND::', SEGMENT), F0, F1) as CLUSTER_LABEL from scored_rows")
    assert rows_of(got) == rows_of(scoring.score_by_key(df, models).select("CUSTOMER_ID", "CLUSTER_LABEL"))
    assert sql_scorer.function_sql(models.limit(0), ["F0"], "none").endswith("return -1")
    with pytest.raises(ValueError):
        sql_scorer.function_sql(spark.range(sql_scorer.MOST_MODELS + 1).selectExpr(
            "'CLUSTERED' as status", "string(id) as segment_key", "array('f') as features", "array(0D) as center", "array(1D) as scale",
            "array(array(0D)) as centroids"), ["F"])


def labelled_rows(spark, n=30, dims=3, seed=0):
    r = np.random.default_rng(seed)
    rows = [(i, f"s{i % 2}", r.normal(size=dims).tolist(), int(r.integers(0, 2))) for i in range(n)]
    labelled = spark.createDataFrame(rows, "CUSTOMER_ID long, SEGMENT_KEY string, Z array<double>, CLUSTER_LABEL int")
    models = spark.createDataFrame(
        [(f"s{s}", r.normal(size=(2, dims)).tolist()) for s in range(2)], "segment_key string, centroids array<array<double>>")
    return rows, labelled, models


def brute_shap(rows, centroids, score):
    """Shapley values by their definition, from all feature orders' marginal gains, averaged per (segment, cluster)."""
    out = {}
    for _, segment, z, label in rows:
        background = [b for _, s, b, _ in rows if s == segment]
        dims = len(z)

        def v(kept, z=z, label=label, segment=segment, background=background):
            return np.mean([score([z[j] if j in kept else b[j] for j in range(len(z))], centroids[segment], label) for b in background])

        phi = []
        for j in range(dims):
            rest = [i for i in range(dims) if i != j]
            total = 0.0
            for mask in range(2 ** len(rest)):
                kept = {i for n, i in enumerate(rest) if mask >> n & 1}
                weight = math.factorial(len(kept)) * math.factorial(dims - len(kept) - 1) / math.factorial(dims)
                total += weight * (v(kept | {j}) - v(kept))
            phi.append(total)
        out.setdefault((segment, label), []).append(phi)
    return {k: (np.abs(p).mean(axis=0), np.mean(p, axis=0)) for k, p in out.items()}


def py_margin(x, centres, label):
    far = [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in centres]
    return min(f for i, f in enumerate(far) if i != label) - far[label]


@pytest.mark.parametrize("score, plain", [
    (kernel_shap.margin, py_margin), (kernel_shap.own_distance, lambda x, c, k: sum((a - b) ** 2 for a, b in zip(x, c[k], strict=True)))])
def test_kernel_values_are_the_shapley_values(spark, score, plain):
    rows, labelled, models = labelled_rows(spark)
    centroids = {r["segment_key"]: r["centroids"] for r in models.collect()}
    names = ["a", "b", "c"]
    want = brute_shap(rows, centroids, plain)
    got = kernel_shap.kernel_shap(labelled, models, names, "r", "t", score).collect()
    assert {(r["SEGMENT"], r["CLUSTER"]) for r in got} == set(want)
    for r in got:
        absolute, mean = want[r["SEGMENT"], r["CLUSTER"]]
        assert [r["CLUSTER_SHAP"][f] for f in names] == pytest.approx(absolute, abs=1e-9)
        assert [r["CLUSTER_MEAN"][f] for f in names] == pytest.approx(mean, abs=1e-9)
        assert sum(r["CLUSTER_MEAN"].values()) == pytest.approx(r["FULL"] - r["BASE"], abs=1e-9)
    if score is kernel_shap.own_distance:
        closed = {(r["SEGMENT"], r["CLUSTER"]): r["CLUSTER_SHAP"] for r in explain.cluster_shap(labelled, models, names, "r", "t").collect()}
        for r in got:
            assert r["CLUSTER_SHAP"] == pytest.approx(closed[r["SEGMENT"], r["CLUSTER"]], abs=1e-9)


def test_many_features_are_explained_from_drawn_coalitions(spark):
    _, labelled, models = labelled_rows(spark, n=12, dims=12, seed=3)
    kept, weight = kernel_shap.coalitions(12, 400)
    assert len(kept) <= 400 and weight.sum() == 400 and (kept.sum(axis=1) % 12 != 0).all()
    names = [f"f{i}" for i in range(12)]
    got = kernel_shap.kernel_shap(labelled, models, names, "r", "t", kernel_shap.own_distance, most_coalitions=400, max_rows=5).collect()
    closed = {(r["SEGMENT"], r["CLUSTER"]): r["CLUSTER_SHAP"] for r in explain.cluster_shap(labelled, models, names, "r", "t", max_rows=5).collect()}
    for r in got:  # an additive score is fitted exactly by any coalitions that determine the regression
        assert r["CLUSTER_SHAP"] == pytest.approx(closed[r["SEGMENT"], r["CLUSTER"]], abs=1e-6)
    one = kernel_shap.kernel_shap(
        labelled.withColumn("Z", F.slice("Z", 1, 1)), models.withColumn("centroids", F.transform("centroids", lambda c: F.slice(c, 1, 1))), ["f"], "r", "t").collect()
    assert all(r["CLUSTER_MEAN"]["f"] == pytest.approx(r["FULL"] - r["BASE"]) for r in one)


def test_additive_scores_need_no_coalitions(spark):
    """The closed form but for the order of the sums, so that ties round alike; the regression over coalitions agrees."""
    _, labelled, models = labelled_rows(spark)
    names = ["a", "b", "c"]

    def values(df):
        return {(r["SEGMENT"], r["CLUSTER"]): r.asDict() for r in df.collect()}

    found = kernel_shap.kernel_shap(labelled, models, names, "r", "t")
    assert "aggregate(" not in found._jdf.queryExecution().optimizedPlan().toString()
    got, closed = values(found), values(explain.cluster_shap(labelled, models, names, "r", "t"))
    for k, r in got.items():
        assert r["CLUSTER_SHAP"] == pytest.approx(closed[k]["CLUSTER_SHAP"], abs=1e-14)
    slow = values(kernel_shap.kernel_shap(labelled, models, names, "r", "t", lambda x: kernel_shap.own_distance(x)))
    for k, r in got.items():
        for c in ("CLUSTER_SHAP", "CLUSTER_MEAN"):
            assert r[c] == pytest.approx(slow[k][c], abs=1e-9)
        assert (r["BASE"], r["FULL"]) == pytest.approx((slow[k]["BASE"], slow[k]["FULL"]), abs=1e-9)


def test_documents_of_unknown_shape(spark):
    docs = spark.createDataFrame([
        (1, '{"A": {"p1": 1, "p99": "9.5", "note": "x"}, "B": {"mean": "n/a"}, "C": 3}'), (2, '{"v": 1, "stats": {"D": {"null_pct": 0.5, "more": {"deep": [1]}}}}'),
        (3, "{oops"), (4, "[]"), (5, None), (6, '{"x": [{"p1": 2}]}')], "DOCUMENT int, value string")
    got = {(r["DOCUMENT"], r["FEATURE"]): r for r in loose_json.baseline_rows(docs).collect()}
    assert set(got) == {(1, "A"), (1, "B"), (2, "D"), (3, None), (4, None), (5, None), (6, "0")}
    assert (got[1, "A"]["BASE_P1"], got[1, "A"]["BASE_P99"], got[1, "A"]["EXTRA"]) == (1.0, 9.5, {"note": "x"})
    assert got[1, "B"]["BASE_MEAN"] is None and got[2, "D"]["BASE_NULL_PCT"] == 0.5
    assert [got[i, None]["PROBLEM"] for i in (3, 4, 5)] == ["no JSON", "no feature", "no JSON"]
    paths = {(r["DOCUMENT"], tuple(r["PATH"])): r["VALUE"] for r in loose_json.leaves(docs).collect()}
    assert paths[1, ("C",)] == "3" and paths[2, ("stats", "D", "more", "deep")] == "[1]" and paths[4, ()] == "[]"


class _Cluster:
    """Stands for a session of a cluster without a checkpoint folder."""

    class conf:
        @staticmethod
        def get(name, default=None):
            return "file:/opt/here/spark-warehouse" if name == "spark.sql.warehouse.dir" else default

    class sparkContext:
        master = "spark://somewhere:7077"

        @staticmethod
        def getCheckpointDir():
            return None


def test_local_folders_are_refused_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.staging_root(_Cluster)
