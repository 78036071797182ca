import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierloom.operators import explain, scoring
from tierloom.schemas import SEGMENT_MODEL

ROWS = "CUSTOMER_ID long, SEGMENT string, MOST_RECENT_INDUSTRY_CODE_DESC string, f0 double, F1 double"


def model(key="IND::S", features=("f0", "f1"), center=(1.0, 1.0), scale=(2.0, 2.0), centroids=((0.0, 0.0), (2.0, 2.0)),
          status="CLUSTERED"):
    return ("run", "t", key, *key.split("::"), status, 10, 2, 0.5, None, list(features),
            list(center) if center else None, list(scale) if scale else None, [list(c) for c in centroids], None, None, None, None)


def models(spark, *rows):
    return spark.createDataFrame(list(rows) or [model()], SEGMENT_MODEL)


def test_segment_scoring_rules(spark):
    rows = spark.createDataFrame([
        (1, "S", "ind", 1.0, 1.0), (2, "S", "Ind", 5.0, 5.0), (3, "S", "IND", 3.0, 3.0), (4, "Z", "ind", 1.0, 1.0),
        (5, "S", "ind", None, 1.0), (6, "S", "ind", float("nan"), 1.0), (7, None, None, 1.0, 1.0)], ROWS)
    scored = scoring.score_segments(rows, models(spark), "run", "2001-01-01T00:00:00Z")
    assert scored.columns == ["CUSTOMER_ID", "SEGMENT", "CLUSTER_LABEL", "RUNID", "SCORED_AT_UTC"]
    got = {r["CUSTOMER_ID"]: r["CLUSTER_LABEL"] for r in scored.collect()}
    assert got == {1: 0, 2: 1, 3: 0, 4: -1, 5: -1, 6: -1, 7: -1}  # 3 is a tie


def test_missing_column_scores_as_zero(spark):
    rows = spark.createDataFrame([(1, "S", "ind", 9.0)], "CUSTOMER_ID long, SEGMENT string, MOST_RECENT_INDUSTRY_CODE_DESC string, F1 double")
    m = models(spark, model(center=None, scale=None, centroids=((9.0, 9.0), (0.0, 9.0))))
    assert scoring.score_segments(rows, m, "r", "").first()["CLUSTER_LABEL"] == 1


def test_models_with_different_features(spark):
    rows = spark.createDataFrame([(1, "S", "ind", 0.0, 5.0), (2, "T", "ind", 0.0, 5.0)], ROWS)
    m = models(spark, model(), model("IND::T", features=("F1",), center=None, scale=(1.0,), centroids=((0.0,), (5.0,))))
    got = {r["CUSTOMER_ID"]: r["CLUSTER_LABEL"] for r in scoring.score_by_key(rows, m).collect()}
    assert got[2] == 1


def test_skipped_models_do_not_score(spark):
    rows = spark.createDataFrame([(1, "S", "ind", 0.0, 5.0)], ROWS)
    assert scoring.score_by_key(rows, models(spark, model(status="SKIPPED_TOO_SMALL"))).first()["CLUSTER_LABEL"] == -1


def test_global_scoring_imputes_medians(spark):
    rows = spark.createDataFrame([(1, 1.0, "a"), (2, 3.0, "b"), (3, None, "c"), (4, 100.0, "d")], "id long, f0 double, note string")
    m = models(spark, model(features=("f0",), center=(0.0,), scale=(1.0,), centroids=((0.0,), (3.0,), (99.0,))))
    out = scoring.score_global(rows, m, "run", "now")
    got = {r["ID"]: (r["F0"], r["CLUSTER_LABEL"]) for r in out.collect()}
    assert got == {1: (1.0, 0), 2: (3.0, 1), 3: (3.0, 1), 4: (100.0, 2)}
    assert "NOTE" in out.columns
    m2 = models(spark, model(features=("f0", "f7")))
    assert {r["CLUSTER_LABEL"] for r in scoring.score_global(rows, m2, "run", "now").collect()} == {-1}


def test_segment_prefix(spark):
    m = models(spark, model("CONSUMER::A"), model("Consumer::B"), model("COMMERCIAL::A"))
    assert explain.select_segments(m, "consumer").count() == 2
    assert explain.select_segments(m, "").count() == 3


def labelled(spark, n=30, seed=2):
    rng = np.random.default_rng(seed)
    rows = [(i, "S", "ind", float(a), float(b)) for i, (a, b) in enumerate(rng.normal(2, 3, size=(n, 2)))]
    df = spark.createDataFrame(rows, ROWS)
    m = models(spark)
    return explain.scaled_labelled(df, m).persist(), m


def shapley(value, d):
    phi = np.zeros(d)
    for order in itertools.permutations(range(d)):
        have = set()
        for j in order:
            before = value(have)
            have = have | {j}
            phi[j] += value(have) - before
    return phi / math.factorial(d)


def test_distance_shapley_matches_all_coalitions(spark):
    df, m = labelled(spark)
    rows = df.collect()
    z = np.array([r["Z"] for r in rows])
    centers = np.array(m.first()["centroids"])
    want = {}
    for r in rows:
        c = centers[r["CLUSTER_LABEL"]]

        def value(have, x=np.array(r["Z"]), c=c):
            mixed = z.copy()
            for j in have:
                mixed[:, j] = x[j]
            return ((mixed - c) ** 2).sum(axis=1).mean()

        want.setdefault(r["CLUSTER_LABEL"], []).append(np.abs(shapley(value, 2)))
    got = explain.cluster_shap(df, m, ["F0", "F1"], "run", "t", background_fraction=1.0, max_rows=0)
    for r in got.collect():
        assert [r["CLUSTER_SHAP"]["F0"], r["CLUSTER_SHAP"]["F1"]] == pytest.approx(np.mean(want[r["CLUSTER"]], axis=0))
    assert got.columns == ["SEGMENT", "CLUSTER", "CLUSTER_SHAP", "RUNID", "RUNTIMESTAMP"]


def test_explain_cap_and_small_background(spark):
    df, m = labelled(spark)
    got = explain.cluster_shap(df, m, ["F0", "F1"], "run", "t", background_fraction=0.0, max_rows=5).collect()
    assert all(v is not None for r in got for v in r["CLUSTER_SHAP"].values())


def test_label_shapley_of_an_irrelevant_feature_is_zero(spark):
    rng = np.random.default_rng(0)
    rows = [(i, "S", "ind", float(a), float(b)) for i, (a, b) in enumerate(rng.normal(2, 3, size=(60, 2)))]
    m = models(spark, model(centroids=((0.0, 1.0), (2.0, 1.0))))  # only the first feature separates
    df = explain.scaled_labelled(spark.createDataFrame(rows, ROWS), m)
    for r in explain.cluster_shap_label(df, m, ["F0", "F1"], "run", "t", draws=6).collect():
        assert r["CLUSTER_SHAP"]["F1"] == 0.0 and r["CLUSTER_SHAP"]["F0"] > 0.1


def test_scored_labels_are_within_k(spark):
    df, m = labelled(spark)
    assert df.where((F.col("CLUSTER_LABEL") < 0) | (F.col("CLUSTER_LABEL") >= 2)).count() == 0


def test_text_features_count_as_numbers_and_only_named_columns_are_read(spark, tmp_path):
    rows = [(1, "S", "ind", "9.5", 1.0), (2, "S", "ind", "0.1", 1.0), (3, "S", "ind", "n/a", 1.0)]
    kind = "CUSTOMER_ID long, SEGMENT string, MOST_RECENT_INDUSTRY_CODE_DESC string, f0 string, unused double"
    spark.createDataFrame(rows, kind).write.parquet(str(tmp_path / "rows"))
    m = models(spark, model(features=("f0",), center=None, scale=None, centroids=((0.0,), (10.0,))))
    scored = scoring.score_segments(spark.read.parquet(str(tmp_path / "rows")), m, "r", "")
    assert {r["CUSTOMER_ID"]: r["CLUSTER_LABEL"] for r in scored.collect()} == {1: 1, 2: 0, 3: -1}
    assert "unused" not in scored._jdf.queryExecution().executedPlan().toString()


def test_all_rows_are_explained_by_default(spark):
    df, m = labelled(spark)
    default = sorted(map(str, explain.cluster_shap(df, m, ["F0", "F1"], "run", "t").collect()))
    assert default == sorted(map(str, explain.cluster_shap(df, m, ["F0", "F1"], "run", "t", 1.0, 0).collect()))
