import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierloom.functions.vectors import nearest
from tierloom.operators import customers as cust
from tierloom.operators import kmeans, scaling, selection, training
from tierloom.operators import kmeans_chunks as kc
from tierloom.operators.silhouette import silhouette
from tierloom.sources.staging import stage

SCHEMA = "CUSTOMER_ID long, SEGMENT string, MOST_RECENT_INDUSTRY_CODE_DESC string, F0 double, F1 double"
FEATS = ["F0", "F1"]


def blobs(seed=3, per=40, centers=((0, 0), (10, 0), (0, 10)), segment="S", start=0):
    rng = np.random.default_rng(seed)
    pts = np.concatenate([rng.normal(c, 0.6, size=(per, 2)) for c in centers])
    return [(start + i, segment, "ind", float(x), float(y)) for i, (x, y) in enumerate(pts)]


def reference_silhouette(z, labels):
    z, labels = np.asarray(z), np.asarray(labels)
    d = np.sqrt(((z[:, None] - z[None]) ** 2).sum(-1))
    out = []
    for i in range(len(z)):
        own = labels == labels[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, labels == other].mean() for other in set(labels) - {labels[i]})
        out.append(0.0 if max(a, b) == 0 else (b - a) / max(a, b))
    return float(np.mean(out))


@pytest.mark.parametrize("block_rows", [3, 7, 4096])
def test_silhouette_matches_brute_force(spark, block_rows):
    rng = np.random.default_rng(1)
    rows, want = [], {}
    for seg, n in (("a", 40), ("b", 13)):
        z = rng.normal(size=(n, 3)).round(1)
        z[1] = z[0]
        by_z = {}
        for v in z:
            by_z[tuple(v)] = by_z.get(tuple(v), 0) + 1
        distinct = list(by_z)
        labels = {k: [int(abs(hash((k, v))) % k) for v in distinct] for k in (2, 4)}
        labels[2][0], labels[2][1] = 0, 1
        labels[4][0], labels[4][1:] = 3, [x % 3 for x in labels[4][1:]]
        for i, v in enumerate(distinct):
            rows.append((seg, list(map(float, v)), by_z[v], [2, 4], [labels[2][i], labels[4][i]]))
        for k in (2, 4):
            full = [(v, labels[k][i]) for i, v in enumerate(distinct) for _ in range(by_z[v])]
            want[seg, k] = reference_silhouette([v for v, _ in full], [x for _, x in full])
    df = spark.createDataFrame(
        rows, "SEGMENT_KEY string, Z array<double>, W long, KS array<int>, LABELS array<int>").repartition(3)
    got = {(r["SEGMENT_KEY"], r["K"]): r["SILHOUETTE"] for r in silhouette(df, block_rows).collect()}
    assert got == pytest.approx(want, abs=1e-12)
    assert all(-1 <= v <= 1 for v in got.values())


def test_silhouette_of_a_single_label(spark):
    df = spark.createDataFrame(
        [("s", [0.0], 1, [2], [1]), ("s", [1.0], 2, [2], [1])],
        "SEGMENT_KEY string, Z array<double>, W long, KS array<int>, LABELS array<int>")
    assert silhouette(df).first()["SILHOUETTE"] == -1.0


def test_nearest_takes_the_first_on_a_tie(spark):
    df = spark.createDataFrame([([0.0, 0.0], [[1.0, 0.0], [0.0, 1.0], [5.0, 5.0]])], "z array<double>, c array<array<double>>")
    for dims in (2, None):
        assert df.select(F.expr(f"({nearest('z', 'c', dims)}).label as l")).first()["l"] == 0
    assert spark.sql(f"select {nearest('z', 'c')} as n from (select cast(null as array<double>) z, array(array(1D)) c)").first()["n"] is None


def test_scaler_handles_constant_features(spark):
    df = spark.createDataFrame(
        [(i, "k", float(i), 7.0) for i in range(9)], "CUSTOMER_ID long, SEGMENT_KEY string, F0 double, F1 double")
    scaler = scaling.robust_scaler(df, FEATS)
    row = scaler.first()
    assert row["CENTER"] == [4.0, 7.0] and row["SCALE"] == [4.0, 1.0]
    z = {r["CUSTOMER_ID"]: r["Z"] for r in scaling.scaled_rows(df, scaler, FEATS).collect()}
    assert z[8] == [1.0, 0.0]


def test_readiness_statuses(spark):
    rows = [(i, "small", "x", 1.0, 1.0) for i in range(4)]
    rows += [(10 + i, "holes", "x", float("inf") if i % 2 else 1.0, 1.0) for i in range(6)]
    rows += [(20 + i, "good", "x", float(i), 1.0) for i in range(6)]
    rows += [(30 + i, None, "x", float(i), 1.0) for i in range(6)]
    df = spark.createDataFrame(rows, SCHEMA)
    sizes = cust.segment_sizes(cust.training_rows(df, FEATS))
    got = {r["SEGMENT_KEY"]: r for r in cust.readiness(sizes, 5).collect()}
    assert {k: r["STATUS"] for k, r in got.items()} == {
        "X::small": "SKIPPED_TOO_SMALL", "X::holes": "SKIPPED_AFTER_DROPOFF", "X::good": "READY", "X::NA": "READY"}
    assert got["X::holes"]["CUSTOMER_COUNT"] == 6 and got["X::holes"]["USABLE_COUNT"] == 3
    assert (got["X::good"]["K_LO"], got["X::good"]["K_HI"]) == (2, 3)
    none = {r["SEGMENT_KEY"]: r["STATUS"] for r in cust.readiness(sizes, 5, clusters_min=4, clusters_max=5).collect()}
    assert none["X::good"] == "NO_K_CANDIDATES"
    absent = cust.training_rows(df, ["F0", "F9"])
    assert not absent.where("USABLE").count()
    status = cust.readiness(cust.segment_sizes(absent), 5, features_missing=True).where("SEGMENT = 'good'").first()
    assert status["STATUS"] == "MISSING_FEATURES"


def test_k_candidates_are_never_reversed(spark):
    sizes = spark.createDataFrame([("a", 3), ("b", 9)], "SEGMENT_KEY string, USABLE_COUNT long")
    ks = cust.explode_k(cust.k_candidates(sizes, 3, 10))
    assert sorted((r["SEGMENT_KEY"], r["K"]) for r in ks.collect()) == [("b", 3), ("b", 4)]


def test_industry_cap_and_filter(spark):
    rows = [(i, "S", "Ind" if i % 2 else "other", 1.0, 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = cust.cap_per_industry(cust.training_rows(df, FEATS, ["IND"]), 7)
    assert kept.count() == 7 and {r["INDUSTRY"] for r in kept.collect()} == {"IND"}


@pytest.fixture(scope="module")
def trained(spark):
    rows = blobs() + blobs(seed=9, centers=((0, 0), (8, 8)), segment="T", start=1000)
    rows += [(5000 + i, "U", "ind", 1.0, 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    opts = training.TrainingOptions(
        features=FEATS, clusters_max=5, min_customers=20, restarts=2, max_iter=15)
    return df, opts, training.fit_segments(df, opts)


def test_fit_finds_the_blobs(spark, trained):
    _, opts, fitted = trained
    table = {r["segment_key"]: r for r in training.choose_models(fitted, opts, "run_1", "t").collect()}
    assert table["IND::S"]["status"] == "CLUSTERED" and table["IND::S"]["best_k"] == 3
    assert table["IND::T"]["best_k"] == 2 and table["IND::T"]["best_silhouette"] > 0.7
    assert [s["k"] for s in table["IND::S"]["results_k"]] == [2, 3, 4, 5]
    assert table["IND::U"]["status"] == "NO_VALID_K"  # one distinct point
    assert len(table["IND::S"]["centroids"]) == 3 and table["IND::U"]["centroids"] is None


def test_inertia_falls_with_k_and_fit_is_repeatable(spark, trained):
    df, opts, fitted = trained
    by_k = {(r["SEGMENT_KEY"], r["K"]): r["INERTIA"] for r in fitted.models.collect()}
    assert by_k["IND::S", 3] < by_k["IND::S", 2] / 4
    again = {(r["SEGMENT_KEY"], r["K"]): r["INERTIA"] for r in training.fit_segments(df, opts).models.collect()}
    assert again == pytest.approx(by_k, rel=1e-9)


def chunks_of(spark, fitted, rows):
    return kc.packed(fitted.points, rows)


def by_model(df):
    return {(r["SEGMENT_KEY"], r["K"]): r for r in df.collect()}


def test_segments_of_many_chunks_give_the_models_of_one(spark, trained):
    _, opts, fitted = trained
    wanted = fitted.ready.where("STATUS = 'READY'")
    one = by_model(fitted.models)
    for carry in (False, True):
        many = by_model(kmeans.fit(fitted.points, wanted, 2, 5, 2, max_iter=15, chunk_rows=25, carry_bounds=carry))
        assert set(many) == set(one)
        for key, r in many.items():
            assert r["INERTIA"] == pytest.approx(one[key]["INERTIA"], rel=1e-6)
            assert np.array(r["CENTERS"]) == pytest.approx(np.array(one[key]["CENTERS"]), abs=1e-6)
            assert r["ITERATIONS"] == one[key]["ITERATIONS"]


def test_carried_bounds_label_as_plain_rounds_and_skip_distances():
    r = np.random.default_rng(2)
    z = np.concatenate([r.normal(size=(400, 8)) + 4 * r.normal(size=8) for _ in range(12)])
    z = np.concatenate([z, z[:50] * -1, np.zeros((1, 8))])
    points = kc.Points(z, r.integers(1, 5, len(z)).astype(float), r.integers(-2 ** 60, 2 ** 60, len(z)))
    centres = z[r.choice(len(z), 12, replace=False)]
    state, computed = kc.Carried.begin(points, centres), 0
    for rounds in range(1, 30):
        label, _ = kc.nearest(z, centres)
        assert (state.label == label).all()
        assert (state.upper + 1e-9 >= np.sqrt(kc.nearest(z, centres)[1])).all()
        moved = kc.means(*kc.sums(points, label, 12), centres)
        if (moved == centres).all():
            break
        state.move(points, centres, moved)
        centres = moved
    assert rounds > 5 and state.distances < 0.4 * rounds * len(z) * 12


def test_carried_bounds_on_ties_take_the_first():
    z = np.array([[0.0], [1.0], [2.0], [3.0], [4.0]])
    points = kc.Points(z, np.ones(5), np.arange(5))
    state = kc.Carried.begin(points, np.array([[0.0], [3.0]]))
    state.move(points, np.array([[0.0], [3.0]]), np.array([[3.0], [1.0]]))
    assert state.label.tolist() == kc.nearest(z, np.array([[3.0], [1.0]]))[0].tolist() == [1, 1, 0, 0, 0]


def test_distances_of_carried_rounds_are_fewer(spark, trained):
    fitted = trained[2]
    wanted = fitted.ready.where("SEGMENT_KEY = 'IND::S'")
    chunks = chunks_of(spark, fitted, 30).where("SEGMENT_KEY = 'IND::S'")
    plan = kc.Plan(5, 1, 3, 20, passes=1, oversample=6)
    seeds = stage(kc.seed_large(chunks, wanted, plan, 2).where("K = 5"), "seeds")
    limits = kmeans.tolerances(fitted.points, 1e-12, 2)
    plain, carried = (kmeans.iterate(chunks, seeds, limits, 2, 20, carry).first() for carry in (False, True))
    assert carried["CENTERS"] == plain["CENTERS"] and carried["ITERATIONS"] == plain["ITERATIONS"]
    assert carried["DISTANCES"] < 120 * 5 * carried["ITERATIONS"]


def test_inertia_never_rises_and_seeds_beat_random_ones():
    r = np.random.default_rng(5)
    z = np.concatenate([r.normal(size=(300, 2)) + 8 * r.normal(size=2) for _ in range(8)])
    points = kc.Points(z, np.ones(len(z)), r.integers(-2 ** 60, 2 ** 60, len(z)))
    fits = list(kc.fit_chunk(points, 2, 10, kc.Plan(10, 3), 1e-9))
    best = {}
    for k, restart, centres, inertia, _ in fits:
        assert len({tuple(c) for c in centres}) == k
        best[k] = min(best.get(k, math.inf), inertia)
    assert sorted(best, key=best.get) == list(range(10, 1, -1))
    random = []
    for _ in range(10):
        centres, _, _ = kc.lloyd(points, z[r.choice(len(z), 8, replace=False)], 300, 0.0)
        random.append(kc.nearest(z, centres)[1].sum())
    assert best[8] <= min(random) * 1.0001
    centres = z[:6]
    before = math.inf
    for _ in range(10):
        label, d2 = kc.nearest(z, centres)
        assert d2.sum() <= before + 1e-9
        before, centres = d2.sum(), kc.means(*kc.sums(points, label, 6), centres)


def test_draws_follow_the_weights():
    points = kc.Points(np.arange(2000.0)[:, None], np.where(np.arange(2000) % 2, 9.0, 1.0), np.random.default_rng(0).integers(-2 ** 62, 2 ** 62, 2000))
    chosen = np.concatenate([kc.race(points, np.empty((0, 1)), 20, kc.Plan(), 1, n)[1][:, 0] for n in range(100)])
    assert 0.87 < (chosen % 2).mean() < 0.93
    assert not len(kc.race(points, points.z, 5, kc.Plan(), 1, 1)[0])  # every point lies on a centre
    times = kc._poisson(np.full(20_000, 2.5), kc.draws(np.arange(20_000), 7))
    assert abs(times.mean() - 2.5) < 0.05 and abs(times.var() - 2.5) < 0.15


def test_empty_cluster_keeps_its_centre(spark):
    assert kc.means(np.array([2.0, 0.0]), np.array([[1.0], [0.0]]), np.array([[7.0], [99.0]])).tolist() == [[0.5], [99.0]]
    points = spark.createDataFrame([("s", [0.0], 1, 1), ("s", [1.0], 1, 2)], "SEGMENT_KEY string, Z array<double>, W long, POINT_ID long")
    models = spark.createDataFrame([("s", 2, 1, [[0.5], [99.0]])], "SEGMENT_KEY string, K int, RESTART int, CENTERS array<array<double>>")
    moved = kc.moved(models, kc.merged_means(kc.chunk_sums(kc.packed(points, 1), models), 1), 1).first()
    assert moved["CENTERS"] == [[0.5], [99.0]] and moved["SHIFT"] == 0.0


def test_large_segments_go_by_mini_batches(spark, trained):
    df, opts, fitted = trained
    full = by_model(fitted.models)
    mini = by_model(training.fit_segments(df, training.TrainingOptions(
        features=FEATS, clusters_max=3, min_customers=20, restarts=2, max_iter=40, batch_size=60, mini_batch_over=100)).models)
    assert mini["IND::S", 3]["ITERATIONS"] == 40 and mini["IND::T", 2]["ITERATIONS"] < 40  # 120 and 80 rows
    assert mini["IND::S", 3]["INERTIA"] < 1.1 * full["IND::S", 3]["INERTIA"]
    assert mini["IND::T", 2]["INERTIA"] == pytest.approx(full["IND::T", 2]["INERTIA"])


def test_check_finds_wrong_models(spark, trained):
    _, opts, fitted = trained
    good = kmeans.check(fitted.points, fitted.models, 2, opts.tol).collect()
    assert len(good) == 8 and all(r["INERTIA_AGREES"] and r["SETTLED"] and r["FALLS"] for r in good)
    shifted = fitted.models.withColumn("CENTERS", F.transform("CENTERS", lambda c: F.transform(c, lambda x: x + 1.0)))
    bad = kmeans.check(fitted.points, shifted, 2, opts.tol).collect()
    assert not any(r["INERTIA_AGREES"] or r["SETTLED"] for r in bad)


def test_best_k_prefers_the_smaller_on_a_tie(spark):
    scores = spark.createDataFrame([("a", 4, 0.5), ("a", 2, 0.5), ("a", 3, 0.4), ("b", 2, None)], "SEGMENT_KEY string, K int, SILHOUETTE double")
    assert [tuple(r) for r in selection.best_k(scores).collect()] == [("a", 2, 0.5)]


@pytest.mark.parametrize("silhouettes, need, want", [
    ([0.31, 0.27], 1, "ok"), ([0.20], 1, "ok"), ([0.1601], 1, "warn"), ([0.16], 1, "fail"), ([0.5], 2, "fail"), ([], 1, "fail")])
def test_model_gate(spark, silhouettes, need, want):
    """0.2 * 0.8 is slightly above 0.16 in doubles, so 0.16 itself fails."""
    rows = [("r", "CLUSTERED", s) for s in silhouettes] + [("r", "SKIPPED_TOO_SMALL", None)]
    df = spark.createDataFrame(rows, "run_id string, status string, best_silhouette double")
    gate = selection.model_gate(df, min_segments=need)
    assert gate.first()["status"] == want and gate.first()["segments_total"] == len(rows)
    assert selection.accepted_models(gate, "m", "/models/").count() == (want == "ok")


def test_unrolled_distances_agree_with_the_general_form(spark):
    rng = np.random.default_rng(3)
    rows = [(rng.integers(0, 3, 2).astype(float).tolist(), rng.integers(0, 3, (k, 2)).astype(float).tolist())
            for k in (1, 2, 3, 4) for _ in range(20)] + [(None, [[0.0, 0.0]])]
    df = spark.createDataFrame(rows, "z array<double>, c array<array<double>>")
    got = df.selectExpr(f"{nearest('z', 'c', 2, 4)} as a", f"{nearest('z', 'c', 2)} as b")
    assert got.where("not (a.d2 <=> b.d2 and a.label <=> b.label)").count() == 0
    assert "transform" not in got.select("a").distinct()._jdf.queryExecution().executedPlan().toString()


def test_settled_centres_make_no_larger_step():
    for seed in range(40):
        r = np.random.default_rng(seed)
        points = kc.Points(r.normal(size=(400, 2)), np.ones(400), np.arange(400))
        limit = kc.tolerance(points, 5e-3)
        centres, rounds, _ = kc.lloyd(points, points.z[:6], 300, limit)
        step = kc.means(*kc.sums(points, kc.nearest(points.z, centres)[0], 6), centres)
        assert rounds < 300 and ((step - centres) ** 2).sum() <= limit


def test_draws_of_heavy_points_follow_their_weights():
    """e**-rate is tiny from a rate of 42 on: such points were never drawn."""
    u = (np.arange(4000) + 0.5) / 4000
    for rate in (41.0, 42.0, 61.0, 300.0, 500.0):
        times = kc._poisson(np.full(len(u), rate), u)
        assert times.mean() == pytest.approx(rate, rel=1e-3) and times.var() == pytest.approx(rate, rel=0.02)


def test_mini_batches_hold_the_rows_of_small_segments(spark):
    """600 rows, all of which every batch may hold: each batch draws about as many, of light and of heavy points."""
    points = stage(spark.range(600).selectExpr("'s' as SEGMENT_KEY", "array(cast(id as double)) as Z", "1L as W", "id as POINT_ID"), "points")
    drawn = kc.mini_batches(kc.packed(points, 256), 1024, kc.Plan(max_iter=50)).groupBy("BATCH").agg(F.sum("TIMES").alias("N")).collect()
    assert len(drawn) == 50 and all(480 < r["N"] < 720 for r in drawn)


def test_draws_with_an_array_of_salts_are_those_of_each():
    h = np.array([5, -7, 2 ** 62, 5])
    assert kc.draws(h, 42, -2, np.array([0, 3, 9, 1000])).tolist() == [
        kc.draws(h[i:i + 1], 42, -2, n)[0] for i, n in enumerate((0, 3, 9, 1000))]


def test_closest_is_the_first_of_the_least_distances():
    rng = np.random.default_rng(8)
    z, centres = rng.integers(0, 4, (9000, 3)).astype(float), rng.integers(0, 4, (5, 7, 3)).astype(float)
    label, d2 = kc.closest(z, centres)
    for run in range(5):
        far = kc.squared_distances(z, centres[run])
        assert (label[run] == far.argmin(axis=1)).all() and (d2[run] == far.min(axis=1)).all()
        assert (kc.nearest(z, centres[run])[0] == label[run]).all() and (kc.nearest(z[:9], centres[run])[1] == d2[run][:9]).all()


def test_mini_batches_take_models_split_over_arrow_batches(spark):
    points = stage(spark.range(300).selectExpr(
        "if(id < 200, 's', 't') as SEGMENT_KEY", "array(cast(id % 17 as double), cast(id as double)) as Z", "1L as W", "id as POINT_ID"), "points")
    seeds = stage(spark.range(1, 9).selectExpr(
        "explode(array('s', 't')) as SEGMENT_KEY", "cast(2 + id % 2 as int) as K", "cast(id as int) as RESTART",
        "slice(array(array(0D, 1D * id), array(9D, 90D), array(3D, 250D)), 1, cast(2 + id % 2 as int)) as CENTERS"), "seeds")

    def fitted():
        found = kc.fit_mini_batch(kc.packed(points, 256), seeds, 40, kc.Plan(max_iter=20))
        return sorted((r["SEGMENT_KEY"], r["K"], r["RESTART"], r["CENTERS"]) for r in found.collect())

    whole = fitted()
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "3")
    try:
        assert fitted() == whole and len(whole) == 16
    finally:
        spark.conf.set(setting, before)
