import numpy as np
import pytest

from tierloom.operators.silhouette import _Block, distances, silhouette
from tierloom.operators.silhouette_bounds import silhouette_bounds

SCHEMA = "SEGMENT_KEY string, Z array<double>, W long, KS array<int>, LABELS array<int>"


def labelled(spark, sizes, dims=2, seed=0, ks=(2, 3)):
    """Points around three places, labelled by nearness to the first k of them, some with a weight."""
    r = np.random.default_rng(seed)
    rows = []
    for key, n in sizes.items():
        places = r.normal(size=(3, dims)) * 6
        z = places[r.integers(0, 3, n)] + r.normal(size=(n, dims))
        near = np.linalg.norm(z[:, None] - places[None], axis=2)
        for v, d in zip(z, near, strict=True):
            rows.append((key, v.tolist(), int(r.integers(1, 4)), list(ks), [int(d[:k].argmin()) for k in ks]))
    return spark.createDataFrame(rows, SCHEMA)


def values(df):
    return {(r["SEGMENT_KEY"], r["K"]): r for r in df.collect()}


@pytest.mark.parametrize("openness", [0.0, 0.1, 0.4, 5.0])
def test_bounds_hold_the_exact_value(spark, openness):
    df = labelled(spark, {"a": 700, "b": 90, "c": 3}, dims=3)
    exact = {k: r["SILHOUETTE"] for k, r in values(silhouette(df)).items()}
    found = values(silhouette_bounds(df, openness, cell_rows=40, chunk_rows=100))
    assert set(found) == set(exact)
    for k, r in found.items():
        assert r["LOWER"] <= exact[k] <= r["UPPER"]
        if openness == 0.0:
            assert r["UPPER"] - r["LOWER"] < 1e-8
    assert found["a", 2]["POINTS"] == 700


def test_work_grows_slower_than_the_square(spark):
    pairs = {n: values(silhouette_bounds(labelled(spark, {"s": n}), 0.3))["s", 2] for n in (600, 6000)}
    # The square would be 100 times as much, n * root n 32 times.
    assert pairs[6000]["OPENED_PAIRS"] < 60 * pairs[600]["OPENED_PAIRS"]
    assert pairs[6000]["OPENED_PAIRS"] < 6000 ** 2 / 4
    assert pairs[6000]["UPPER"] - pairs[6000]["LOWER"] < 0.05


def test_single_label_copies_and_lone_points(spark):
    rows = [("one", [0.0, 0.0], 5, [2], [0]), ("one", [1.0, 0.0], 1, [2], [0]),
            ("lone", [0.0, 0.0], 1, [2], [0]), ("lone", [3.0, 0.0], 4, [2], [1]), ("lone", [3.5, 0.0], 1, [2], [1]),
            ("same", [2.0, 2.0], 9, [2], [0]), ("same", [4.0, 2.0], 9, [2], [1])]
    df = spark.createDataFrame(rows, SCHEMA)
    exact, found = values(silhouette(df)), values(silhouette_bounds(df, 0.0))
    for k, r in found.items():
        assert r["LOWER"] == pytest.approx(exact[k]["SILHOUETTE"], abs=1e-8) == r["UPPER"]
    assert found["one", 2]["LOWER"] == -1.0
    assert silhouette_bounds(df.limit(0)).collect() == []


def test_distances_keep_their_digits_and_blocks_their_memory():
    """Near points far from the origin, copies, and a tile of near points only; a large block works in bounded tiles."""
    r = np.random.default_rng(4)
    for z in (r.normal(size=(300, 5)) * [1, 1e3, 1, 1, 1] + 1e5, np.repeat(r.normal(size=(40, 3)), 3, axis=0) + 1e-7 * r.normal(size=(120, 3)),
              np.r_[np.full((1, 2), 1e9), 1e-3 * r.normal(size=(200, 2))]):
        want = np.sqrt(((z[:, None] - z[None]) ** 2).sum(axis=2))
        np.testing.assert_allclose(distances(z, z), want, rtol=1e-9)
    block = _Block("a")
    block.hold(r.normal(size=(20_000, 2)), np.ones(20_000), np.array([2]), np.zeros((20_000, 1), dtype=np.int32))
    block.open()
    assert block.buffer.size <= 250_000 and block.step >= 100
