import numpy as np
import pytest
from pyspark.sql import functions as F

from tierloom.operators import drift, quality


def frame(spark, values, name="x"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double")


def numpy_psi(base, cur):
    edges = np.unique(np.quantile(base, np.linspace(0, 1, 11)))
    e, a = np.histogram(base, edges)[0], np.histogram(cur, edges)[0]
    e, a = np.clip(e / max(1, e.sum()), 1e-8, 1), np.clip(a / max(1, a.sum()), 1e-8, 1)
    return float(((a - e) * np.log(a / e)).sum())


@pytest.mark.parametrize("shift, seed", [(0.0, 1), (0.4, 2), (3.0, 3)])
def test_psi_matches_numpy(spark, shift, seed):
    rng = np.random.default_rng(seed)
    base, cur = rng.normal(size=701), rng.normal(shift, 1, size=333)
    row = drift.drift_psi(frame(spark, base), frame(spark, cur), ["x"]).first()
    want = numpy_psi(base, cur)
    assert row["PSI"] == pytest.approx(want, abs=1e-9)
    assert row["STATUS"] == ("fail" if want >= 0.25 else "warn" if want >= 0.1 else "ok")


def test_psi_with_ties_and_edges(spark):
    rng = np.random.default_rng(8)
    base, cur = rng.integers(0, 6, 200), rng.integers(-2, 9, 150)
    row = drift.drift_psi(frame(spark, base), frame(spark, cur), ["x"]).first()
    assert row["PSI"] == pytest.approx(numpy_psi(base, cur), abs=1e-9)
    inside = ((cur >= base.min()) & (cur <= base.max())).mean()
    assert row["OUT_OF_RANGE_SHARE"] == pytest.approx(1 - inside)


def test_self_comparison_is_zero(spark):
    df = spark.range(500).selectExpr("cast(id * 7919 % 500 as double) as x", "id % 4 as CLUSTER_LABEL")
    psi, kl, status = drift.drift_report(df, df, ["x"])
    assert psi.first()["PSI"] == 0.0 and kl.first()["KL"] == pytest.approx(0.0) and status.first()["STATUS"] == "ok"


def test_notes(spark):
    n = 50
    base = spark.range(n).selectExpr("cast(id as double) as good", "1.0 as flat", "if(id < 49, id, null) as few", "cast(null as double) as none")
    rows = {r["FEATURE"]: r for r in drift.drift_psi(base, base, ["good", "flat", "few", "none"]).collect()}
    assert rows["good"]["NOTE"] is None and rows["good"]["PSI"] == 0.0
    assert rows["flat"]["NOTE"] == "low_variance_baseline"
    assert rows["few"]["NOTE"] == "insufficient_samples" and rows["none"]["NOTE"] == "insufficient_samples"
    assert all(r["STATUS"] == "ok" for r in rows.values())


def test_label_shares_keep_one_sided_and_null_labels(spark):
    cur = spark.createDataFrame([(0,), (0,), (1,), (None,)], "CLUSTER_LABEL int")
    base = spark.createDataFrame([(0,), (2,)], "CLUSTER_LABEL int")
    shares = drift.cluster_shares(base, cur)
    got = {r["LABEL"]: (r["CURRENT_SHARE"], r["BASELINE_SHARE"]) for r in shares.collect()}
    assert got == {0: (0.5, 0.5), 1: (0.25, 0.0), 2: (0.0, 0.5), None: (0.25, 0.0)}
    row = drift.cluster_share_kl(shares).first()
    p, q = np.clip([0.5, 0.25, 0, 0.25], 1e-8, 1), np.clip([0.5, 0, 0.5, 0], 1e-8, 1)
    assert row["KL"] == pytest.approx(float((p * np.log(p / q)).sum())) and row["STATUS"] == "fail"
    assert row["LABELS"] == ["0", "1", "2", "NULL"]


def test_tables_without_labels(spark):
    df = spark.range(100).selectExpr("cast(id as double) as x")
    _, kl, status = drift.drift_report(df, df.withColumn("CLUSTER_LABEL", F.lit(1)), ["x"])
    assert kl is None and status.first()["STATUS"] == "ok"


BASE = "FEATURE string, BASE_P1 double, BASE_P99 double, BASE_MEAN double, BASE_NULL_PCT double"


def test_moments_against_stored_statistics(spark):
    cur = spark.range(10).selectExpr("16.0 as a", "5.0 as z", "if(id < 4, null, 1.0) as h", "13.0 as m", "cast(null as double) as n")
    base = spark.createDataFrame([
        ("a", 0.0, 0.0, 10.0, 0.0), ("z", 0.0, 0.0, 0.0, 0.0), ("h", 0.0, 0.0, 1.0, None), ("m", 0.0, 0.0, 10.0, 0.0),
        ("n", 0.0, 0.0, 1.0, 1.0), ("gone", 0.0, 0.0, 1.0, 0.0)], BASE)
    stats = quality.feature_stats(cur, ["a", "z", "h", "m", "n"])
    two = {r["FEATURE"]: r["STATUS"] for r in drift.drift_vs_stats(stats, base).collect()}
    assert two == {"a": "warn", "z": "ok", "h": "fail", "m": "ok", "n": "ok", "gone": "fail"}
    four = {r["FEATURE"]: r["STATUS"] for r in drift.drift_stats_vs_stats(stats, base).collect()}
    assert four == {"a": "fail", "z": "ok", "h": "fail", "m": "warn", "n": "ok", "gone": "fail"}
    assert drift.drift_status(drift.drift_vs_stats(stats, base)).first()["FAILED"] == 2


def test_lacking_columns_are_notes(spark, tmp_path):
    from tierloom.plans import workflow

    base = spark.range(200).selectExpr("cast(id as double) as a", "cast(id as double) as b", "1 as CLUSTER_LABEL")
    current = base.drop("b", "CLUSTER_LABEL").withColumn("c", F.lit(1.0))
    notes = {r["FEATURE"]: (r["NOTE"], r["STATUS"]) for r in drift.drift_psi(base, current, ["a", "b", "c"]).collect()}
    assert notes == {"a": (None, "ok"), "b": ("missing_in_current", "ok"), "c": ("missing_in_baseline", "ok")}
    out = str(tmp_path)
    assert workflow.watch_drift(base, current, out, "d1", ["a", "b"]) == "ok"
    assert "not available" in spark.read.json(f"{out}/d1/drift_clusters").first()["NOTE"]
    broken = base.withColumn("a", F.expr("if(a > 5, raise_error('broken'), a)"))
    assert workflow.watch_drift(base, broken, out, "d2", ["a"]) == "fail"
    row = spark.read.json(f"{out}/d2/drift_status").first()
    assert row["STATUS"] == "fail" and "broken" in row["ERROR"]


def test_statistics_against_statistics(spark, tmp_path):
    from tierloom.plans import workflow

    kind = "FEATURE string, BASE_P1 double, BASE_P99 double, BASE_MEAN double, BASE_NULL_PCT double"
    base = spark.createDataFrame([("a", 0.0, 9.0, 4.0, 0.1), ("b", 0.0, 9.0, 2.0, None)], kind)
    moved = spark.createDataFrame([("a", 0.0, 9.0, 9.0, 0.1), ("b", 0.0, 9.0, 2.0, 0.0)], kind)
    assert workflow.watch_drift_stats(base, str(tmp_path), "self") == "ok"
    assert workflow.watch_drift_stats(base, str(tmp_path), "moved", moved) == "fail"
