import json
import os

import pytest
from pyspark.sql import functions as F

from tierloom.operators import quality, training
from tierloom.plans import fixtures as fx
from tierloom.plans import workflow
from tierloom.schemas import SEGMENT_MODEL
from tierloom.sources import bundle, sinks, staging, tables
from test_scoring_and_explanation import model


def test_writing_a_run_twice_keeps_its_rows_once(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10)
    assert sinks.write_run(df, path, "RUN A/1") == 10
    assert sinks.write_run(df.limit(4), path, "other") == 4
    assert sinks.write_run(df, path, "RUN A/1") == 10
    counts = {r["RUN_ID"]: r["count"] for r in spark.read.parquet(path).groupBy("RUN_ID").count().collect()}
    assert counts == {"RUN_A_1": 10, "other": 4}


@pytest.mark.parametrize("base, run_id, want", [
    ("T", "", "T"), ("T", "run 1/x", "T_run_1_x"), ("T_run_1", "run_1", "T_run_1"), ("T_RUN_20250101_000000", "_RUN_20250101_000000", "T_RUN_20250101_000000"),
    ("T_RUN_20250101_000000", "RUN_20250102_000000", "T_RUN_20250101_000000"), ("T_20250101_000000", "20250102_000000", "T_20250101_000000"),
    ("T_PREPROCESS_RUN_20250101_000000", "EXTRACT_RUN_20250102_000000", "T_PREPROCESS_RUN_20250101_000000_EXTRACT_RUN_20250102_000000"),
    ("T", "é" * 3 + "a" * 60, "T_" + "a" * 47)])
def test_run_suffix_is_appended_once(base, run_id, want):
    assert sinks.run_table_name(base, run_id) == want


def test_append_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append_rows(spark.range(3), path)
    sinks.append_rows(spark.range(3), path)
    assert spark.read.parquet(path).count() == 6
    assert sinks.overwrite_path(spark.range(5), f"{path}-whole") == 5 and sinks.overwrite_path(spark.range(2), f"{path}-whole") == 2
    assert sinks.read_path(spark, f"{path}-whole").count() == 2


def test_catalog_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS tierloom_test")
    try:
        sinks.ensure_explanation_table(spark, "tierloom_test.shap")
        sinks.ensure_explanation_table(spark, "tierloom_test.shap")
        assert spark.table("tierloom_test.shap").columns == ["SEGMENT", "CLUSTER", "CLUSTER_SHAP", "RUNID", "RUNTIMESTAMP"]
        assert sinks.overwrite_table(spark.range(5), "tierloom_test.plain") == 5
        assert tables.read_table(spark, "tierloom_test.plain").count() == 5
    finally:
        spark.sql("DROP DATABASE tierloom_test CASCADE")


def test_reports_and_explanations(spark, tmp_path):
    path = sinks.write_report(spark.range(2), str(tmp_path), "checks", "run-1")
    assert path.endswith("/run_1/checks") and spark.read.json(path).count() == 2
    df = spark.createDataFrame([("A::B", 0, {"x": 1.0}, "plot")], "SEGMENT string, CLUSTER int, CLUSTER_SHAP map<string,double>, CLUSTER_SHAP_PLOT string")
    sinks.write_explanations(df, str(tmp_path / "shap"))
    assert set(spark.read.json(str(tmp_path / "shap")).columns) == {"CLUSTER", "CLUSTER_SHAP", "SEGMENT"}


def test_bundle_runs(spark, tmp_path):
    root = str(tmp_path / "models")
    df = spark.createDataFrame([model("IND::S"), model("IND::T")], SEGMENT_MODEL)
    bundle.write_bundle(df, root)
    bundle.write_bundle(df.withColumn("run_id", F.lit("run_2")).limit(1), root)
    bundle.write_bundle(df, root)
    assert bundle.read_bundle(spark, root).count() == 3
    assert [r["run_id"] for r in bundle.open_run(spark, root).collect()] == ["run_2"]
    assert bundle.open_run(spark, root, "run").count() == 2
    assert [r["run_id"] for r in bundle.open_run(spark, f"{root}/run_id=run_2").collect()] == ["run_2"]
    with pytest.raises(ValueError):
        bundle.open_run(spark, root, "nope")
    assert bundle.bundle_files(spark, root).where("BYTES > 0").count() >= 2


def test_json_export_and_import(spark, tmp_path):
    folder = str(tmp_path / "json")
    df = spark.createDataFrame([model("IND::my seg"), model("IND::T", status="SKIPPED_TOO_SMALL")], SEGMENT_MODEL)
    bundle.export_json(df, folder)
    back = {r["segment_key"]: r for r in bundle.import_json(spark, folder, "segments", False).collect()}
    assert back["IND::my seg"]["centroids"] == [[0.0, 0.0], [2.0, 2.0]] and back["IND::my seg"]["scale"] == [2.0, 2.0]
    assert back["IND::T"]["status"] == "SKIPPED_TOO_SMALL" and back["IND::T"]["centroids"] is None


def test_import_of_pretty_printed_documents(spark, tmp_path):
    doc = {"status": "CLUSTERED", "industry": "CONSUMER", "segment": "A B", "customer_count": 9, "best_k": 2,
           "best_silhouette": 0.4, "results_k": [{"k": 2, "silhouette": 0.4}], "features": ["X"],
           "scaler": {"center": [1.0], "scale": None}, "centroids": [[0.0], [4]], "data_table": "other.table",
           "x_cols": ["X"], "y_col": ["OWN_LABEL"], "target_table": "db.shap"}
    manifest = {"run_id": "r", "run_timestamp": "t", "industries": ["CONSUMER"], "feature_cols": ["X"], "segments": {
        "CONSUMER::A B": {"customer_count": 9, "status": "CLUSTERED", "artifact": "segment_CONSUMER_A_B.json",
                          "best_k": 2, "best_silhouette": 0.4},
        "CONSUMER::C": {"customer_count": 3, "status": "SKIPPED_TOO_SMALL"},
        "CONSUMER::D": {"customer_count": 8, "status": "CLUSTERED", "artifact": "segment_CONSUMER_D.json"}}}
    (tmp_path / "manifest.json").write_text(json.dumps(manifest, indent=2))
    (tmp_path / "segment_CONSUMER_A_B.json").write_text(json.dumps(doc, indent=2))
    rows = {r["segment_key"]: r for r in bundle.import_json(spark, str(tmp_path)).collect()}
    assert rows["CONSUMER::A B"]["centroids"] == [[0.0], [4.0]] and rows["CONSUMER::A B"]["scale"] is None
    assert rows["CONSUMER::A B"]["input_table"] == "other.table"
    named = rows["CONSUMER::A B"]
    assert (named["x_cols"], named["y_col"], named["output_table"]) == (["X"], "OWN_LABEL", "db.shap")
    assert rows["CONSUMER::C"]["status"] == "SKIPPED_TOO_SMALL" and rows["CONSUMER::C"]["y_col"] is None
    assert rows["CONSUMER::D"]["status"] == "ARTIFACT_MISSING"


def test_temporary_tables_are_removed(spark):
    with staging.temporary_tables(spark):
        df = staging.stage(spark.range(3), "probe")
        path = df.inputFiles()[0].replace("file:", "")
        assert df.count() == 3 and os.path.exists(path)
    assert not os.path.exists(path)


OPTS = training.TrainingOptions(
    segment_col="TAM_TIER_SOURCE", clusters_max=3, min_customers=8, restarts=1, max_iter=4)


def test_train_score_explain_and_drift(spark, sf, tmp_path):
    out = str(tmp_path / "out")
    orders = fx.orders_input(spark, sf)
    customers = staging.stage(fx.customers(orders), "customers")
    base = fx.stored_baseline(
        quality.feature_stats(customers, ["ORDER_FREQUENCY"])
    ).where("FEATURE <> 'LIFETIME_VALUE'")
    done = workflow.train_validate_accept(
        orders, base, out, "run-1", "t", fx.AS_OF, OPTS, min_segment_size=2, silhouette_threshold=-1.0)
    assert (done.quality_status, done.feature_status, done.model_status, done.accepted) == ("ok", "ok", "ok", True)
    assert spark.read.parquet(f"{out}/prepared").count() == orders.count()
    assert spark.read.parquet(f"{out}/accepted").count() == 1

    n = workflow.batch_score(spark, customers, f"{out}/models", f"{out}/scored", "now", segment_col="TAM_TIER_SOURCE")
    scored = sinks.read_path(spark, f"{out}/scored")
    assert n == scored.count() == customers.count()
    assert scored.where("CLUSTER_LABEL >= 0").count() > 0

    rows = workflow.explain_clusters(
        spark, customers, f"{out}/models", f"{out}/shap", "run-1", "t", "BUILD", 0.5, segment_col="TAM_TIER_SOURCE")
    shap = spark.read.parquet(f"{out}/shap/cluster_shap")
    assert rows == shap.count() > 0 and shap.where("SEGMENT NOT LIKE 'BUILDING::%'").count() == 0

    labelled = scored.join(customers.select("CUSTOMER_ID", "AVG_ORDER_VALUE"), "CUSTOMER_ID")
    assert workflow.watch_drift(labelled, labelled, f"{out}/reports", "d1", ["AVG_ORDER_VALUE"]) == "ok"
    assert workflow.watch_drift_by_stats(customers, base, f"{out}/reports", "d2") == "ok"


def test_models_name_columns_labels_and_target(spark, tmp_path):
    """One model names its table, a column to report, a label column and a table for its rows."""
    rows = [(i, "S" if i % 2 else "T", "ind", float(i % 7), float(i % 3), i % 2 if i < 18 else 9) for i in range(20)]
    customers = spark.createDataFrame(
        rows, "CUSTOMER_ID long, SEGMENT string, MOST_RECENT_INDUSTRY_CODE_DESC string, F0 double, F1 double, OWN int")
    customers.where("CUSTOMER_ID < 15").write.parquet(str(tmp_path / "own"))
    special = F.col("segment_key") == "IND::S"
    models = spark.createDataFrame([model("IND::S"), model("IND::T")], SEGMENT_MODEL).withColumns({
        "input_table": F.when(special, str(tmp_path / "own")), "x_cols": F.when(special, F.array(F.lit("f1"))),
        "y_col": F.when(special, "OWN"), "output_table": F.when(special, "tierloom_named.shap")})
    bundle.write_bundle(models, str(tmp_path / "models"))
    spark.sql("CREATE DATABASE IF NOT EXISTS tierloom_named")
    try:
        n = workflow.explain_clusters(spark, customers, str(tmp_path / "models"), str(tmp_path / "out"), "run", "t")
        shap = {(r["SEGMENT"], r["CLUSTER"]): r["CLUSTER_SHAP"] for r in spark.read.parquet(str(tmp_path / "out/cluster_shap")).collect()}
        assert n == len(shap) and {k for k in shap if k[0] == "IND::S"} == {("IND::S", 1)}  # odd ids carry label 1
        assert set(shap["IND::S", 1]) == {"f1"} and set(shap["IND::T", 0]) == {"f0", "f1"}
        stored = spark.table("tierloom_named.shap").collect()
        assert [(r["SEGMENT"], r["CLUSTER"], r["RUNID"]) for r in stored] == [("IND::S", 1, "run")]
    finally:
        spark.sql("DROP DATABASE tierloom_named CASCADE")


def test_gates_stop_the_run(spark, sf, tmp_path):
    orders = fx.orders_input(spark, sf)
    few = workflow.train_validate_accept(
        orders.limit(5), None, str(tmp_path / "a"), "r", "t", fx.AS_OF, OPTS)
    assert few.quality_status == "fail" and few.model_status is None
    far = spark.createDataFrame(
        [("ORDER_FREQUENCY", 0.001, 0.002, 0.001, 0.0)],
        "FEATURE string, BASE_P1 double, BASE_P99 double, BASE_MEAN double, BASE_NULL_PCT double")
    out = str(tmp_path / "b")
    stopped = workflow.train_validate_accept(orders, far, out, "r", "t", fx.AS_OF, OPTS)
    assert stopped.feature_status == "fail" and not stopped.accepted
    assert spark.read.json(f"{out}/reports/r/failing_rows").count() == 10


def test_broadcast_only_within_the_size_limit(spark):
    with staging.temporary_tables(spark):
        big, small = spark.range(1000), staging.stage(spark.range(10), "lookup")
        marked = big.join(staging.with_size_check(small), "id")
        plain = big.join(staging.with_size_check(small, limit_bytes=10), "id")
        assert "ResolvedHint" in marked._jdf.queryExecution().analyzed().toString()
        assert "ResolvedHint" not in plain._jdf.queryExecution().analyzed().toString()
        # A table whose size is not known is never marked.
        unknown = spark.createDataFrame([(1,)], "id long")
        assert "ResolvedHint" not in big.join(
            staging.with_size_check(unknown), "id")._jdf.queryExecution().analyzed().toString()


def test_results_do_not_depend_on_broadcasts(spark, sf, monkeypatch):
    from tierloom.plans import catalog

    names = ["segment_assign", "lloyd_step", "score_by_key", "robust_scaler"]
    want = {n: sorted(map(str, catalog.REGISTRY[n](spark, sf).collect())) for n in names}
    monkeypatch.setattr(staging, "BROADCAST_LIMIT_BYTES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert {n: sorted(map(str, catalog.REGISTRY[n](spark, sf).collect())) for n in names} == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_segments_whose_names_read_alike_keep_their_models(spark, tmp_path):
    rows = [model("IND::A B", centroids=((1.0, 1.0), (2.0, 2.0))), model("IND::A_B", centroids=((3.0, 3.0), (4.0, 4.0)))]
    bundle.export_json(spark.createDataFrame(rows, SEGMENT_MODEL), str(tmp_path))
    back = bundle.import_json(spark, str(tmp_path), "segments", False).collect()
    assert {r["segment_key"]: r["centroids"] for r in back} == {
        "IND::A B": [[1.0, 1.0], [2.0, 2.0]], "IND::A_B": [[3.0, 3.0], [4.0, 4.0]]} and len(back) == 2


def test_newest_run_prunes_partitions(spark, tmp_path):
    df = spark.createDataFrame([model()], SEGMENT_MODEL)
    bundle.write_bundle(df.unionByName(df.withColumn("run_id", F.lit("run_9"))), str(tmp_path / "m"))
    plan = bundle.open_run(spark, str(tmp_path / "m"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan and "= run_9" in plan


def test_jobs_in_threads_keep_their_own_tables(spark):
    from threading import Event, Thread

    staged, ended, results = Event(), Event(), []

    def long_job():
        with staging.temporary_tables(spark):
            df = staging.stage(spark.range(5), "probe")
            staged.set()
            ended.wait(60)
            results.append(df.count())

    thread = Thread(target=long_job)
    thread.start()
    staged.wait(60)
    with staging.temporary_tables(spark):
        staging.stage(spark.range(3), "probe").count()
    ended.set()
    thread.join()
    assert results == [5]
