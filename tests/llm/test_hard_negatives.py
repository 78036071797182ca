import math
import random

import numpy as np
import pytest

from tierloom.llm import hard_negatives
from tierloom.llm.queries import REGISTRY

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=50):
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = tuple(math.floor(256 * float(np.float32(x))) for x in v)
        kept[(i, (label + 1) % 10 if i % 7 == 0 else label, v)] = None
    out = []
    for a, label, v in kept:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, other) for i, other, w in kept if i != a)
        for p, i, _ in [s for s in scored if s[2] == label][:5]:
            fit = [(n, j) for n, j, other in scored if other != label and 50 * p >= 100 * n >= 95 * p]
            out += [(a, i, r + 1, j, -p, -n) for r, (n, j) in enumerate(fit[:3])]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select(COLUMNS).collect())


def test_negatives_of_given_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    got = found(REGISTRY["op12_hard_negatives"](spark, sf))
    assert got and got == brute([tuple(r) for r in rows])


def test_groups_and_hot_copies_change_nothing(spark):
    r = random.Random(3)
    rows = [(i, [r.gauss(0, 1) + (i % 3) for _ in range(10)], i % 3) for i in range(400)]
    rows += [(i, rows[7][1], r.choice([0, 1, 1, 2])) for i in range(400, 600)]  # a third of all rows are one vector
    df = spark.createDataFrame(rows + rows[::9], SCHEMA)
    expected = brute(rows, every=20)
    assert found(hard_negatives.mine(df, every=20)) == expected
    assert found(hard_negatives.mine(df, every=20, group_bytes=10 * 8 * 10, seed_share=2)) == expected


def test_odd_vectors(spark):
    r = random.Random(4)
    rows = [(i, [r.gauss(0, 1) for _ in range(4)], i % 2) for i in range(40)]
    rows += [(None, [1.0] * 4, 0), (50, None, 0), (51, [1.0, None, 0.0, 0.0], 1), (52, [float("nan")] * 4, 1), (53, [float("inf")] * 4, 1),
             (54, [1.0] * 4, None), (100, [0.0] * 4, 1), (150, [0.5] * 4, 7), (200, [0.25] * 4, 1), (200, [0.5, 0.25, 0.25, 0.25], 1),
             (-50, [0.5] * 4, 0)]
    short = [(60, [1.0, 1.0], 0)]  # another length: takes no part
    df = spark.createDataFrame([(*x, "a", 2.0) for x in rows + short], SCHEMA + ", id string, score double")
    assert found(hard_negatives.mine(df, every=10)) == brute(rows, every=10)
    assert found(hard_negatives.mine(df.limit(0))) == []
    with pytest.raises(ArithmeticError):
        hard_negatives.mine(spark.createDataFrame([(1, [1e30], 0)], SCHEMA))


def test_bounds_hold_and_prune():
    r = np.random.default_rng(0)
    # Vectors that are level within their segments, as the method wants them.
    a, b = (np.floor(256 * (np.repeat(r.normal(size=(n, 16)), 4, axis=1) + 0.05 * r.normal(size=(n, 64)))) for n in (50, 400))
    scores = (a @ b.T).astype(np.int64)
    least = np.sort(scores, axis=1)[:, -5]
    counts = []
    row, col, score = hard_negatives.survivors(
        hard_negatives.Summarised.of(a, False), hard_negatives.Summarised.of(b, False), np.ones(scores.shape, bool), least,
        np.full(50, 2 ** 62), counts)
    assert sorted(zip(row, col, score, strict=True)) == sorted((i, j, scores[i, j]) for i, j in zip(*np.nonzero(scores >= least[:, None]), strict=True))
    assert counts[0] > counts[1] > counts[2] and counts[2] < 0.05 * scores.size


def test_large_components_are_exact():
    r = np.random.default_rng(1)
    a, b = (r.integers(-2 ** 28, 2 ** 28, size=(n, 8)).astype(np.float64) for n in (3, 20))
    row, col, score = hard_negatives.survivors(
        hard_negatives.Summarised.of(a, True), hard_negatives.Summarised.of(b, True), np.ones((3, 20), bool), np.full(3, -2 ** 62),
        np.full(3, 2 ** 62))
    assert len(row) == 60
    assert all(s == sum(int(x) * int(y) for x, y in zip(a[i], b[j], strict=True)) for i, j, s in zip(row, col, score.tolist(), strict=True))
