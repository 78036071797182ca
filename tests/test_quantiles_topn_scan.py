import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierloom.operators.quantiles import exact_quantiles, long_features
from tierloom.operators.topn import top_n_per_group
from tierloom.sources import tables

PROBS = [0.0, 0.1, 0.25, 0.3, 0.5, 0.75, 0.99, 1.0]


def check(spark, groups, **kw):
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, VALUE double")
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], PROBS, **kw).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert got[g]["N"] == len(vs)
        np.testing.assert_allclose(got[g]["Q"], np.quantile(vs, PROBS), rtol=1e-12, atol=1e-12)


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(5)
    check(spark, {
        "one": [3.0], "two": [1.0, 2.0], "ties": [7.0] * 50 + [1.0], "normal": rng.normal(size=999),
        "grid": rng.integers(0, 5, 200)})


@pytest.mark.parametrize("accuracy", [20, 100, 1000])
def test_exact_even_with_a_coarse_sketch(spark, accuracy):
    """Rank errors far above one row must be absorbed by the brackets."""
    rng = np.random.default_rng(accuracy)
    check(spark, {
        "a": rng.exponential(size=5000), "b": rng.integers(0, 30, 4000), "hot": [1.0] * 3000 + list(rng.normal(size=1500))},
        accuracy=accuracy)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=40))
def test_exact_quantiles_small_groups(spark, values):
    check(spark, {"g": values})


def test_bad_values_become_null(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("inf",), ("NaN",), (None,)], "a string")
    rows = [r["VALUE"] for r in long_features(df, [], ["a"]).collect()]
    assert sorted(rows, key=str) == [1.5, None, None, None, None]


def test_unbounded_group_is_not_aggregated_in_one_buffer(spark):
    df = spark.range(10).selectExpr("'g' as g", "cast(id as double) as VALUE")
    plan = exact_quantiles(df, ["g"], [0.5])._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in plan


def test_top_n_per_group(spark):
    df = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id % 50 as string)) as g", "id * 7919 % 1000 as o")
    got = top_n_per_group(df, ["g"], [F.col("o"), F.col("id")], 5, salts=7)
    want = {}
    for r in sorted(df.collect(), key=lambda r: (r["o"], r["id"])):
        want.setdefault(r["g"], [])
        if len(want[r["g"]]) < 5:
            want[r["g"]].append(r["id"])
    have = {}
    for r in got.collect():
        have.setdefault(r["g"], set()).add(r["id"])
    assert have == {g: set(v) for g, v in want.items()}


def test_sample_is_exact_size_and_repeatable(spark):
    df = spark.range(5000).withColumnRenamed("id", "k").withColumn("v", F.col("k") * 2)
    a = tables.sample_scan(df, ["k"], "k", 300)
    assert a.columns == ["k"] and a.count() == 300
    assert {r["k"] for r in a.collect()} == {r["k"] for r in tables.sample_scan(df.repartition(7), ["k"], "k", 300).collect()}
    assert tables.sample_scan(df, ["k"], "k", 0).count() == 5000
    assert tables.sample_scan(df, ["k"], "k", 9000).count() == 5000


def test_sample_with_one_hot_key_still_has_its_size(spark):
    df = spark.range(4000).selectExpr("if(id < 3999, 1, 2) as k")
    assert tables.sample_scan(df, ["k"], "k", 500).count() == 500


def test_scan_helpers(spark):
    df = spark.createDataFrame([(1, 2.0, "a", 3)], "id long, x double, s string, cluster_label int")
    assert tables.normalized_scan(df).columns == ["ID", "X", "S", "CLUSTER_LABEL"]
    assert tables.normalized_scan(None, spark).count() == 0
    assert tables.numeric_columns(df) == ["id", "x"]
    assert tables.explanation_columns(df) == ["id", "x"]


def test_extract_window_is_pushed_down(spark, sf):
    df = spark.read.parquet(f"{sf}/orders.parquet")
    cut = tables.extract_window(df, "o_orderkey", "1996-01-01", "1997-01-01", date_col="o_orderdate")
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    limited = tables.extract_window(df, "o_orderkey", "1996-01-01", "1997-01-01", 20, date_col="o_orderdate")
    assert limited.count() == 20
