"""Decontamination and nearest neighbours against brute force, and on odd rows."""

import random
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierloom.llm import decontam_cgk as dc
from tierloom.llm import rp_forest
from tierloom.llm.queries import REGISTRY
from tests_llm_helpers import prose


def brute_search(item, region):
    """Fewest edits between item and any stretch of region (rows: item, columns: region)."""
    row = [0] * (len(region) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(region, 1):
            new.append(min(row[j - 1] + (w != x), row[j] + 1, new[-1] + 1))
        row = new
    return min(row[1:], default=None)


@given(st.lists(st.integers(0, 3), min_size=1, max_size=12), st.lists(st.integers(0, 3), min_size=1, max_size=25))
@settings(max_examples=300, deadline=None)
def test_bit_vector_search_is_exact(item, region):
    found = dc.stretch(item, region, len(item))
    assert found[0] == brute_search(item, region)
    edits, first, last = found
    if first <= last:
        whole = [list(range(last - first + 2))] + [[0] * (last - first + 2) for _ in item]
        for i, w in enumerate(item, 1):
            whole[i][0] = i
            for j, x in enumerate(region[first:last + 1], 1):
                whole[i][j] = min(whole[i - 1][j - 1] + (w != x), whole[i - 1][j] + 1, whole[i][j - 1] + 1)
        assert whole[-1][-1] == edits


def edited(words, n, r):
    words = list(words)
    for _ in range(n):
        at = r.randrange(len(words))
        kind = r.choice("rid")
        if kind == "r":
            words[at] = f"new{r.randrange(999)}"
        elif kind == "i":
            words.insert(at, f"new{r.randrange(999)}")
        elif len(words) > 1:
            del words[at]
    return words


def test_edited_passages_are_found_and_clean_texts_left(spark):
    r = random.Random(8)
    items = [(i, " ".join(f"w{r.randrange(400)}" for _ in range(r.randint(15, 60)))) for i in range(60)]
    docs, planted = [], set()
    for d in range(200):
        words = [f"w{r.randrange(400)}" for _ in range(r.randint(0, 150))]
        if d % 2:
            i, text = r.choice(items)
            item = text.split()
            words[5:5] = edited(item, r.randint(0, int(0.2 * len(item))), r)
            planted.add((d, i))
        docs.append((d, " ".join(words)))
    found = dc.best_places(dc.find(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")))
    got = {(x.doc_id, x.item_id): x for x in found.collect()}
    want = {}
    for d, text in docs:
        for i, item in items:
            edits = brute_search(item.split(), text.split())
            if edits is not None and edits <= int(0.2 * len(item.split())):
                want[d, i] = edits
    assert planted <= set(want) and set(got) <= set(want)
    assert len(got) >= 0.97 * len(want)
    assert all(x.edits == want[k] for k, x in got.items())


@pytest.mark.parametrize("size", [120, 250, 500, 1000])
def test_edited_passages_of_long_items_are_found(spark, size):
    """All the edits allowed: of all kinds in half of the documents, insertions only in the others."""
    r = random.Random(size)
    items = [[f"w{r.randrange(5000)}" for _ in range(size)] for _ in range(20)]
    docs = []
    for i, item in enumerate(items):
        inserted = list(item)
        for _ in range(int(0.2 * size)):
            inserted.insert(r.randrange(1, len(inserted)), f"new{r.randrange(999)}")
        for k, passage in enumerate((edited(item, int(0.2 * size), r), inserted)):
            around = [[f"w{r.randrange(5000)}" for _ in range(40)] for _ in range(2)]
            docs.append((2 * i + k, " ".join(around[0] + passage + around[1])))
    found = dc.best_places(dc.find(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string"))).collect()
    assert all(x.item_id == x.doc_id // 2 and x.edits <= int(0.2 * size) for x in found)
    assert len(found) >= 0.97 * len(docs)


def test_fitted_repetitions_reach_the_target():
    s = dc.Settings()
    for size in (n for n in s.sizes(s.piece_words) if n >= s.min_item_words):
        repetitions, _, recall = dc.fitted(size, s.edits(size), s)
        assert recall >= s.target_recall and repetitions <= s.most_repetitions


def test_exact_passages_of_the_tables(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in REGISTRY["op8_decontamination"](spark, sf).collect()}
    assert {(d, i) for d, t in docs.items() for i, x in items.items() if x in t} <= got
    for d, i in got:
        item, words = (dc.WordHasher().words(t).tolist() for t in (items[i], docs[d]))
        assert brute_search(item, words) <= int(0.2 * len(item))


@pytest.mark.parametrize("unspaced", [False, True])
def test_short_items_are_found_exactly(spark, unspaced):
    """Items of one to four words, and sentences of a script without spaces, against every stretch of every text."""
    r = random.Random(unspaced)
    words = [chr(0x3042 + 2 * i) for i in range(20)] if unspaced else [f"w{i}" for i in range(20)]
    glue = "" if unspaced else " "
    items = [(i, [r.choice(words) for _ in range(1 + i % 4)]) for i in range(40)] + [(40, words[:12])]
    docs = [(d, [r.choice(words) for _ in range(r.randint(0, 12))]) for d in range(150)]
    docs.append((150, words[3:5] + words[:12] + words[7:9]))
    found = dc.best_places(dc.find(
        spark.createDataFrame([(d, f"{glue.join(t)}.") for d, t in docs], "doc_id long, text string"),
        spark.createDataFrame([(i, glue.join(t).upper()) for i, t in items], "item_id long, text string"))).collect()
    want = {
        (d, i): next(a for a in range(len(t)) if t[a:a + len(x)] == x)
        for d, t in docs for i, x in items if len(x) < 5 and any(t[a:a + len(x)] == x for a in range(len(t)))}
    assert {(f.doc_id, f.item_id): f.first_word for f in found if f.item_words < 5} == want
    assert all(f.edits == 0 for f in found if f.item_words < 5) and (150, 40) in {(f.doc_id, f.item_id) for f in found}


def test_decontamination_odd_rows(spark, odd, none):
    items = spark.createDataFrame(
        [(1, None), (2, ""), (3, "too few words"), (None, prose(1, 40)), (5, prose(1, 40)), (5, "a a a a a a")],
        "item_id long, text string")
    found = dc.best_places(dc.find(odd, items)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(8, None), (8, 5), (9, None), (9, 5), (None, None), (None, 5)} & {
        (r.doc_id, r.item_id) for r in found} and {r.item_id for r in found} == {None, 5}
    clean = dc.clean(odd, items)
    assert clean.columns == odd.columns and clean.count() == odd.where("text is null").count() + odd.where(
        "text is not null").where(~(odd.text == prose(1, 40))).count()
    assert dc.clean(none, items).count() == 0 and dc.find(none, items).count() == 0
    assert dc.clean(odd, items.limit(0)).count() == odd.count()


# Nearest neighbours


def brute_nearest(rows, k, every):
    ids, x = [i for i, _ in rows], np.array([v for _, v in rows])
    out = {}
    for i, v in rows:
        if i % every == 0:
            s = x @ v
            order = sorted((j for j in range(len(ids)) if ids[j] != i), key=lambda j: (-s[j], ids[j]))[:k]
            out[i] = [(ids[j], s[j]) for j in order]
    return out


def test_recall_on_the_tables(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    want = brute_nearest([(r.vec_id, np.array(r.embedding, dtype=np.float64)) for r in table], 20, 20)
    got = {}
    for r in REGISTRY["op6_rp_forest"](spark, sf).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(want)
    hits = 0
    for q, rows in got.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 21))
        assert [(-s, v) for _, v, s in rows] == sorted((-s, v) for _, v, s in rows)
        hits += len({v for _, v, _ in rows} & {v for v, _ in want[q]})
    assert hits >= 0.9 * 20 * len(want)


def test_copies_ties_and_unequal_norms(spark):
    r = np.random.default_rng(1)
    rows = [(i, (r.normal(size=8) * r.uniform(0.1, 5)).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(200)]
    got = rp_forest.nearest(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=5, every=10, trees=4, leaf_rows=400,
        target_recall=1.0).collect()
    want = brute_nearest([(i, np.array(v)) for i, v in rows], 5, 10)
    found = {}
    for x in sorted(got, key=lambda x: (x.query_id, x.rank)):
        found.setdefault(x.query_id, []).append(x.vec_id)
    assert {q: [v for v, _ in w] for q, w in want.items()} == found  # the sample is all rows: nothing is missed


@pytest.mark.parametrize("nearest", [1, 20])
def test_a_query_is_not_its_own_neighbour_in_the_fit(nearest):
    """The recall of the fitted visits, measured on the other rows of the sample alone."""
    points = np.random.default_rng(4).normal(size=(3000, 16))
    points /= np.linalg.norm(points, axis=1)[:, None]
    forest = rp_forest.Forest.grow(points, 1.0, 4, 7)
    forest.calibrate(points, nearest, 0.9)
    scores = points @ points.T
    np.fill_diagonal(scores, -np.inf)
    best, codes = np.argsort(-scores, axis=1)[:, :nearest], forest.codes(points)
    hits = 0
    for q, leaves in enumerate(forest.visited(points, forest.visits)):
        hits += np.isin(codes[best[q]], leaves).any(axis=1).sum()
    assert hits >= 0.87 * nearest * len(points)


def test_repeated_rows_leave_room_for_other_ids(spark):
    rows = [(1, [1.0, 0.0])] * 30 + [(i, [1.0, 0.0]) for i in range(2, 30)] + [(100 + i, [0.5, 0.1 * i]) for i in range(30)]
    got = rp_forest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=20, every=20).collect()
    found = {q: [x.vec_id for x in sorted(got, key=lambda x: x.rank) if x.query_id == q] for q in (20, 100)}
    assert found == {20: [i for i in range(1, 22) if i != 20], 100: list(range(1, 21))}


def random_forest(r, dims, trees, depth):
    """A forest of random cuts, without the time to fit one."""
    grown = [rp_forest.Tree(depth, r.normal(size=(1 << depth, dims + 1)), r.normal(size=1 << depth)) for _ in range(trees)]
    return rp_forest.Forest(grown, 10.0)


def test_memory_of_visits_does_not_grow_with_queries_times_leaves():
    """4,000 queries in 8 trees of 512 leaves: 16 million gaps, 131 MB as an array and 500 MB as Python numbers."""
    r = np.random.default_rng(6)
    forest, queries = random_forest(r, 8, 8, 9), r.normal(size=(4000, 8))
    tracemalloc.start()
    codes = forest.visited(queries, 12)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 150e6
    alone = np.concatenate([forest.visited(queries[i:i + 1], 12) for i in range(0, 4000, 400)])
    assert (codes[::400] == alone).all()


def test_visits_are_packed_and_read_again():
    r = np.random.default_rng(7)
    for codes in (r.permuted(np.tile(np.arange(3000), (40, 1)), axis=1)[:, :30], np.array([[255], [0], [510], [1019], [254], [70_000]])):
        steps, ends = rp_forest.Asked.packed(codes)
        asked = rp_forest.Asked(np.arange(len(codes)), np.zeros((len(codes), 2)), np.zeros(len(codes)), steps, ends)
        for a, z in ((0, len(codes)), (2, 5), (len(codes) - 1, len(codes))):
            leaves, queries = asked.visits(a, z)
            assert (np.diff(leaves) >= 0).all()
            assert sorted(zip(queries.tolist(), leaves.tolist(), strict=True)) == [
                (q, c) for q, row in enumerate(np.sort(codes[a:z], axis=1).tolist()) for c in row]


@pytest.mark.parametrize("block", [50, 1 << 21])
@pytest.mark.parametrize("floor", [-np.inf, 1.0])
@pytest.mark.parametrize("kind, scale", [("f8", 1.0), ("f4", 1.0), ("f4", 2.0 ** 80), ("f4", 2.0 ** -80)])
def test_chunks_give_the_best_of_the_visited_leaves(monkeypatch, block, floor, kind, scale):
    """Many ties, ids with several vectors, blocks smaller than a leaf, and products that four bytes do not hold."""
    monkeypatch.setattr(rp_forest, "BLOCK", block)
    r = np.random.default_rng(8)
    k, forest, points = 4, random_forest(r, 3, 3, 3), r.integers(-2, 3, size=(400, 3)).astype(np.float64)
    ids = np.append(np.arange(350), np.full(50, 400))
    codes, asks = forest.codes(points), points[::5]
    visits = forest.visited(asks, 5)
    points, asks, floor = points * scale, asks * scale, floor * scale ** 2
    asked = rp_forest.Asked(ids[::5], asks.astype(kind), np.full(len(asks), floor), *rp_forest.Asked.packed(visits))
    chunk, got = rp_forest.Chunk(ids, points.astype(kind), codes), []
    assert block > 50 or len(list(asked.parts())) > 1
    for a, z in asked.parts():
        query, found, score = chunk.best(asked, a, z, k)
        # Those of an id that is asked several times follow each other by query.
        got += sorted(zip(query.tolist(), found.tolist(), score.tolist(), strict=True))
    want = []
    for a, z in asked.parts():
        part = []
        for q in range(a, z):
            best = {}
            for i in np.flatnonzero(np.isin(codes, visits[q]).any(axis=1) & (ids != asked.ids[q])).tolist():
                if (s := float(asks[q] @ points[i])) >= floor:
                    best[int(ids[i])] = max(s, best.get(int(ids[i]), -np.inf))
            part += [(int(asked.ids[q]), i, s) for i, s in sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]]
        want += sorted(part)
    assert got == want


def test_groups_of_queries_give_the_rows_of_one_group(spark, monkeypatch):
    r = np.random.default_rng(9)
    rows = [(i % 240, r.normal(size=6).tolist()) for i in range(400)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    whole = sorted(map(tuple, rp_forest.nearest(table, k=5, every=4, target_recall=1.0).collect()))
    monkeypatch.setattr(rp_forest, "GROUP_BYTES", 3000)
    assert sorted(map(tuple, rp_forest.nearest(table, k=5, every=4, target_recall=1.0).collect())) == whole and len(whole) == 60 * 5


@pytest.mark.parametrize("kind", ["array<float>", "array<double>"])
def test_vectors_that_take_no_part(spark, kind):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [1.0]), (20, [0.25, 1.0]), (None, [1.0, 1.0]), (8, [])]
    table = spark.createDataFrame(rows, f"vec_id long, embedding {kind}")
    got = {(x.query_id, x.rank, x.vec_id, x.score) for x in rp_forest.nearest(table.where("vec_id is not null")).collect()}
    assert got == {(0, 1, 1, 0.5), (0, 2, 20, 0.25), (20, 1, 1, 0.625), (20, 2, 0, 0.25)}
    assert rp_forest.nearest(table.where("vec_id in (2, 3)")).count() == 0
    assert rp_forest.nearest(table.where("vec_id = 0")).count() == 0
    assert rp_forest.nearest(table.limit(0)).count() == 0
    assert rp_forest.nearest(table).count() >= 4
