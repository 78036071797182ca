import json

import pytest
from pyspark.sql import functions as F

from tierloom.functions.columns import bound_check, severity
from tierloom.operators import quality
from tierloom.sources import baseline as bl

BASE = "FEATURE string, BASE_P1 double, BASE_P99 double, BASE_MEAN double, BASE_NULL_PCT double"
STATS = "FEATURE string, TOTAL_ROWS long, P1 double, P99 double, MEAN double, NULL_PCT double"


@pytest.mark.parametrize("base, cur, flex, want", [
    (100.0, 149.0, 0.5, "in"), (100.0, 151.0, 0.5, "out"), (100.0, 49.0, 0.5, "out"), (100.0, 50.0, 0.5, "in"),
    (0.0, 0.9, 0.5, "in"), (0.0, 1.1, 0.5, "out"), (1e-7, -0.9, 0.5, "in"),
    (-100.0, -120.0, 0.5, "in"), (-100.0, -160.0, 0.5, "out"), (None, 1.0, 0.5, "missing"), (1.0, None, 0.5, "missing"),
])
def test_bounds(spark, base, cur, flex, want):
    df = spark.createDataFrame([(base, cur, flex)], "b double, c double, f double")
    assert df.select(bound_check(F.col("b"), F.col("c"), F.col("f")).alias("r")).first()["r"] == want


def test_severity(spark):
    df = spark.createDataFrame([(10.0, 25.0), (0.0, 3.0), (None, 1.0)], "b double, c double")
    got = [r["s"] for r in df.select(severity(F.col("b"), F.col("c")).alias("s")).collect()]
    assert got == pytest.approx([1.5, 3.0, 0.0])


def test_feature_statuses_and_gate(spark):
    base = spark.createDataFrame([
        ("same", 1.0, 9.0, 5.0, 0.0), ("moved", 1.0, 9.0, 5.0, 0.0), ("far", 1.0, 9.0, 5.0, None),
        ("holes", 1.0, 9.0, 5.0, 0.1), ("few_holes", 1.0, 9.0, 5.0, 0.0), ("edge_holes", 1.0, 9.0, 5.0, 0.0),
        ("wide", 1.0, 9.0, 5.0, 0.0), ("gone", 1.0, 9.0, 5.0, 0.0)], BASE)
    stats = spark.createDataFrame([
        ("same", 10, 1.0, 9.0, 5.0, 0.0), ("moved", 10, 1.0, 14.0, 5.0, 0.0), ("far", 10, 1.0, 19.0, 5.0, 0.0),
        ("holes", 10, 1.0, 9.0, 5.0, 0.5), ("few_holes", 10, 1.0, 9.0, 5.0, 0.2), ("edge_holes", 10, 1.0, 9.0, 5.0, 0.1),
        ("wide", 10, 1.0, 14.0, 5.0, 0.0)], STATS)
    overrides = bl.flex_overrides(spark, '{"wide": {"flex": 0.9}}')
    checks = quality.feature_check(stats, base, overrides)
    got = {r["FEATURE"]: r["STATUS"] for r in checks.collect()}
    assert got == {"same": "ok", "moved": "warn", "far": "fail", "holes": "fail", "few_holes": "warn",
                   "edge_holes": "ok", "wide": "ok", "gone": "fail"}
    gate = quality.feature_gate(checks).first()
    assert (gate["STATUS"], gate["FAILED"], gate["WARNED"], gate["PRESENT_FEATURES"]) == ("fail", 3, 2, 7)
    mild = quality.feature_check(stats, base.where("FEATURE IN ('same', 'moved')"))
    assert quality.feature_gate(mild).first()["STATUS"] == "warn"
    none = quality.feature_check(stats.limit(0), base.where("FEATURE = 'gone'"))
    assert quality.feature_gate(none).first()["STATUS"] == "fail"


def test_invalid_overrides_are_ignored(spark):
    assert bl.flex_overrides(spark, "{not json").count() == 0


def test_statistics_of_any_number_of_features(spark):
    df = spark.range(500).selectExpr("cast(id as double) as a", "if(id % 4 = 0, null, cast(id % 7 as double)) as b")
    wide = sorted(quality.feature_stats(df, ["a", "b"]).collect())
    assert wide[1]["NULL_PCT"] == 0.25 and wide[0]["P99"] == 494.0
    for n in (50, 51):
        names = [f"f{i}" for i in range(n)]
        many = quality.feature_stats(df.select(*[F.col("a").alias(f) for f in names]), names).collect()
        assert [tuple(r)[1:] for r in many] == [tuple(wide[0])[1:]] * n
        empty = df.where("a < 0").select(*[F.col("a").alias(f) for f in names])
        assert [(r["FEATURE"], r["TOTAL_ROWS"]) for r in quality.feature_stats(empty, names).collect()] == [
            (f, 0) for f in names]


def test_extreme_rows_of_a_negative_baseline(spark):
    df = spark.createDataFrame([(1, -9.0), (2, -1.2), (3, -20.0), (4, 3.0)], "id long, v double")
    checks = spark.createDataFrame(
        [("v", "fail", True, -10.0, -1.0, 0.5)],
        "FEATURE string, STATUS string, PRESENT boolean, BASE_P1 double, BASE_P99 double, FLEX_PCT double")
    assert sorted(r["id"] for r in quality.failing_rows(df, checks, ["v"], "id").collect()) == [3, 4]


def test_baseline_document_round_trip(spark, tmp_path):
    df = spark.range(200).selectExpr("cast(id as double) as a", "cast(null as double) as b")
    path = str(tmp_path / "baseline")
    bl.baseline_document(quality.feature_stats(df, ["a", "b"])).coalesce(1).write.text(path)
    rows = {r["FEATURE"]: r for r in bl.read_baseline(spark, path).collect()}
    assert rows["a"]["BASE_MEAN"] == 99.5 and rows["b"]["BASE_MEAN"] is None and rows["b"]["BASE_NULL_PCT"] == 1.0


def test_baseline_json_with_absent_fields(spark, tmp_path):
    path = tmp_path / "baseline.json"
    path.write_text(json.dumps({"a": {"p1": 1, "mean": 2.5}, "b": {}}, indent=2))
    rows = {r["FEATURE"]: r for r in bl.read_baseline(spark, str(path)).collect()}
    assert rows["a"]["BASE_P1"] == 1.0 and rows["a"]["BASE_P99"] is None and rows["b"]["BASE_NULL_PCT"] is None


def test_coverage(spark):
    base = spark.createDataFrame([("a", 1.0, 1.0, 1.0, 0.0), ("z", 1.0, 1.0, 1.0, 0.0)], BASE)
    got = {r["FEATURE"]: r["PRESENT"] for r in quality.baseline_coverage(base, spark.range(1).selectExpr("1 as a")).collect()}
    assert got == {"a": True, "z": False}


def test_data_quality(spark):
    df = spark.range(150).selectExpr("id", "if(id < 30, null, id) as x")
    rows = {r["COLUMN_NAME"]: r for r in quality.dq_check(df, ["id", "x", "y"]).collect()}
    assert rows["x"]["NULL_RATE"] == 0.2 and rows["x"]["STATUS"] == "ok"
    assert not rows["y"]["PRESENT"] and rows["y"]["STATUS"] == "fail"
    assert {r["STATUS"] for r in quality.dq_check(df.limit(99), ["id"]).collect()} == {"fail"}
    assert quality.dq_check(df.limit(0), ["id"]).first()["NULL_RATE"] is None


def test_failing_rows(spark):
    df = spark.range(100).selectExpr("id", "cast(id as double) as a", "0.0 as b")
    checks = spark.createDataFrame(
        [("a", "fail", True, 10.0, 60.0, 0.5), ("b", "fail", True, None, None, 0.5)],
        "FEATURE string, STATUS string, PRESENT boolean, BASE_P1 double, BASE_P99 double, FLEX_PCT double")
    rows = quality.failing_rows(df, checks, ["a", "b"], "id", 8).collect()
    assert len(rows) == 8 and all(r["FEATURE"] == "a" and (r["a"] > 90 or r["a"] < 5) for r in rows)
    everything = quality.failing_rows(df, checks, ["a", "b"], "id", 1000).collect()
    assert {r["id"] for r in everything} == {*range(5), *range(91, 100)}
