import numpy as np
from tests_llm_helpers import classes

from tierloom.llm import multi_index
from tierloom.llm.queries import REGISTRY

SCHEMA = "vec_id long, embedding array<double>"


def brute(ids, points, threshold=0.9):
    """n_links and smallest id reachable of each row; ids are different."""
    points = multi_index.unit(points)
    near = points @ points.T >= threshold
    np.fill_diagonal(near, False)
    place = {i: k for k, i in enumerate(ids)}
    roots = classes(ids, lambda a, b: near[place[a], place[b]])
    return {i: (int(near[k].sum()), roots[i]) for k, i in enumerate(ids)}, near


def found(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in df.collect()}


def partners(r, n, dims, groups, cosines):
    """n random rows, then for each of `groups` of them one partner at each cosine."""
    base = multi_index.unit(r.normal(size=(n, dims)))
    rows = [base]
    for c in cosines:
        aside = r.normal(size=(groups, dims))
        aside -= (aside * base[:groups]).sum(axis=1, keepdims=True) * base[:groups]
        rows.append(c * base[:groups] + np.sqrt(1 - c * c) * multi_index.unit(aside))
    return np.concatenate(rows)


def test_given_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    expected, _ = brute([r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], dtype=np.float64))
    assert found(REGISTRY["op13_multi_index"](spark, sf)) == expected


def test_recall_at_the_threshold_and_above(spark):
    r = np.random.default_rng(1)
    points = partners(r, 3000, 32, 400, [0.9001, 0.92, 0.95, 0.99])
    ids = list(range(len(points)))
    df = spark.createDataFrame([(i, p.tolist()) for i, p in zip(ids, points, strict=True)], SCHEMA)
    got = found(multi_index.near_duplicates(df, cell_rows=20, block_rows=64))
    expected, _ = brute(ids, points)
    links, wanted = sum(n for n, _ in got.values()), sum(n for n, _ in expected.values())
    assert wanted > 2 * 4 * 400 and 0.95 * wanted <= links <= wanted
    assert all(got[i][0] <= expected[i][0] for i in ids)
    assert np.mean([got[i] == expected[i] for i in ids]) > 0.95


def test_hot_group_over_many_blocks_counts_every_link_once(spark):
    r = np.random.default_rng(2)
    hot = r.normal(size=16) + 0.02 * r.normal(size=(300, 16))  # a third of all rows, all linked
    points = np.concatenate([hot, r.normal(size=(300, 16)), np.repeat(r.normal(size=(1, 16)), 200, axis=0), 3 * hot[:5]])
    ids = [int(i) for i in r.permutation(len(points))]
    df = spark.createDataFrame([(i, p.tolist()) for i, p in zip(ids, points, strict=True)], SCHEMA)
    got = found(multi_index.near_duplicates(df, target_recall=1.0, cell_rows=10, block_rows=16))
    assert got == brute(ids, points)[0]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.1, 0.0]), (3, [0.0, 1.0, 0.0]), (3, [0.0, 1.0, 0.0]), (4, None), (5, [0.0, 0.0, 0.0]),
        (6, [1.0, None, 0.0]), (7, [nan, 1.0, 0.0]), (8, [inf, 1.0, 0.0]), (9, [1.0, 0.0]), (None, [1.0, 0.0, 0.0]), (10, []),
        (11, [0.0, 1e-300, 0.0]), (12, [0.0, -1e300, 0.0]), (13, [1e300, 1e299, 0.0])]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA + ", n_links int, component_id string")
    got = sorted(map(repr, (tuple(r) for r in multi_index.near_duplicates(df).collect())))
    linked = {1: (2, 1), 2: (2, 1), 13: (2, 1), 3: (1, 3), 11: (1, 3)}
    expected = [(i, *linked.get(i, (0, i)), linked.get(i, (0, i))[1] == i) for i, _ in rows]
    assert got == sorted(map(repr, expected))
    assert multi_index.near_duplicates(df.limit(0)).collect() == []
    line = spark.createDataFrame([(1, [2.0]), (2, [3.0]), (3, [-1.0])], SCHEMA)
    assert found(multi_index.near_duplicates(line)) == {1: (1, 1), 2: (1, 1), 3: (0, 3)}


def test_traversal_visits_cells_in_order_of_distance():
    r = np.random.default_rng(3)
    points = multi_index.unit(r.normal(size=(200, 12)))
    index = multi_index.MultiIndex.fit(points, 7, 0.9, 0.95)
    cells, starts = index.visits(points)
    first, second = index.distances(points)
    for n, (a, z) in enumerate(zip(starts, starts[1:], strict=False)):
        far = (first[n][:, None] + second[n][None, :]).ravel()
        assert (np.diff(far[cells[a:z]]) >= 0).all() and far[cells[a]] == 0
        assert sorted(cells[a:z]) == np.flatnonzero(far <= index.margin).tolist()
