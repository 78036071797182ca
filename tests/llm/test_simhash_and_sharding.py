import itertools
import re
import zlib
from collections import Counter

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tierloom.llm import sharding, simhash_bk
from tierloom.llm.components import connected_components
from tierloom.llm.queries import REGISTRY
from tests_llm_helpers import classes, prose


def brute_fingerprint(text, width):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
    shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64(s.encode(), 42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_query_equals_brute_force(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in REGISTRY["op4_simhash_bk"](spark, sf).collect()}
    prints = {d: brute_fingerprint(t, 3) for d, t in docs.items()}
    want = classes(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert {d: (r.fingerprint, r.component_id) for d, r in got.items()} == {
        d: (f"{prints[d]:016x}", want[d]) for d in docs}


@given(st.lists(st.integers(0, (1 << 64) - 1), min_size=1, max_size=40), st.integers(0, 6))
@settings(max_examples=60, deadline=None)
def test_tree_search_is_exact(values, radius):
    values = list(dict.fromkeys(v & 0xFFFF for v in values))
    tree = simhash_bk.BkTree()
    for v in values:
        tree.add(v)
    for q in values:
        assert sorted(tree.within(q, radius)) == sorted(v for v in values if (v ^ q).bit_count() <= radius)


@pytest.mark.parametrize("tree_size", [2, 1000])
def test_links_survive_resharding(spark, tree_size):
    """Values that crowd one shard: all links are kept whatever the size of trees."""
    base = 0x0123456789ABCDEF
    values = {base ^ (1 << i) for i in range(64)} | {base ^ 0b111, 5, 7, (1 << 63) | 1, (1 << 63) | 3, (1 << 40)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = simhash_bk.links(spark.createDataFrame([(v,) for v in signed], "fp long"), 2, tree_size)
    got = {r.node: r.root for r in connected_components(found).collect()}
    want = classes({v: v for v in signed}, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 2)
    assert {v: got.get(v, v) for v in signed} == want


def test_odd_rows(odd, none):
    rows = simhash_bk.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    zero = [r for r in rows if r.fingerprint == "0" * 16]
    assert len(zero) == 3 and len({r.component_id for r in zero}) == 1
    assert simhash_bk.near_duplicates(none).count() == 0
    kept = simhash_bk.keep_one(odd)
    assert kept.columns == odd.columns and simhash_bk.keep_one(none).count() == 0
    assert kept.count() == len({" ".join((r.text or "").lower().split()) for r in odd.collect()})


def test_one_of_each_similar_group_stays(spark):
    texts = {i: prose(100 + i, 120) for i in range(6)}
    rows = [(i, t) for i, t in texts.items()]
    rows += [(10 + i, t) for i, t in texts.items()]  # exact copies
    rows += [(20 + i, t + " changed end") for i, t in texts.items()]  # near copies
    shared = prose(999, 60)
    rows += [(40 + i, shared + " " + prose(500 + i, 200)) for i in range(4)]  # a long passage in common, else different
    kept = {r.doc_id for r in simhash_bk.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == set(range(6)) | {40, 41, 42, 43}


def test_large_shards_of_near_copies(spark):
    shard = simhash_bk.SimilarShard(0.8, 20, tree_size=8)
    import numpy as np

    links = []
    for i in range(50):
        links += shard.add(i, 0b1111 ^ (1 << i % 20), np.array([1, 2, 3, 4, 5, 6, 7, 8, 9, 10 + i], dtype=np.uint32))
    assert len({shard.top(i) for i in range(50)}) == 1 and len(links) == 49


@pytest.mark.parametrize("size", [64 << 20, 40_000])
def test_similar_pairs_of_a_hot_shard_are_found(spark, size):
    """5,000 texts that share one least hash, as texts around a template do, and no other; also in blocks of few bytes."""
    import random

    import numpy as np

    r, nodes, sets = random.Random(5), [], []
    for i in range(5000):
        if i % 2 == 0:
            fp, words = r.getrandbits(63), r.sample(range(1 << 31), 18)
        own = np.array(sorted([*words, (1 << 31) + i]), dtype=np.uint32)  # 18 of 20 in common
        nodes.append((i, i, fp ^ (1 << i % 8), [7, *[4 * i + k for k in range(3)]], 80))
        sets.append((i, bytearray(own.tobytes())))
    found = simhash_bk.similar_links(
        spark.createDataFrame(nodes, "node long, uid long, fp long, slots array<long>, bytes long").repartition(4),
        spark.createDataFrame(sets, "uid long, shingles binary"), 0.8, shard_bytes=size).collect()
    assert {frozenset((x.u, x.v)) for x in found} == {frozenset((i, i + 1)) for i in range(0, 5000, 2)}


def test_no_text_of_a_large_shard_is_forgotten():
    import numpy as np

    shard, links = simhash_bk.SimilarShard(0.8, 20, tree_size=2), []
    for node, first in enumerate([0, 2, 1000, 2000, 4]):  # the last is similar to the second, not to the first
        links += shard.add(node, 0, np.arange(first, first + 20, dtype=np.uint32))
    assert links == [(0, 1), (1, 4)]


def check_shards(rows, shards, n):
    sizes = Counter(r.shard for r in rows)
    counts = [sizes.get(s, 0) for s in range(shards)]
    assert sum(counts) == n and max(counts) - min(counts) <= 1 and set(sizes) <= set(range(shards))
    for s, size in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(size))


def test_shards_are_even_and_keep_groups_together(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = REGISTRY["op1_label_sharding"](spark, sf).collect()
    check_shards(rows, 16, len(docs))
    for r in rows:
        raw = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    home = {}
    for r in rows:
        home.setdefault(docs[r.doc_id], set()).add(r.shard)
    assert max(map(len, home.values())) == 1


def test_a_group_larger_than_a_shard(spark):
    rows = spark.createDataFrame([(i, "hot" if i < 400 else "g%d" % (i // 4) if i < 800 else None) for i in range(1003)],
                                 "uid long, key string")
    got = sharding.assign(rows, 8).collect()
    check_shards(got, 8, 1003)
    hot = Counter(r.shard for r in got if r.key == "hot")
    assert len(hot) <= 5  # 400 rows over quotas of 125: four shards are the least
    small = {}
    for r in got:
        if r.key and r.key != "hot":
            small.setdefault(r.key, set()).add(r.shard)
    assert sum(len(s) > 1 for s in small.values()) <= 10


def test_grants_respect_the_limits():
    wanted = {(0, 1, 3): 50, (2, 1, 1): 50, (1, 2, 2): 10}
    load, most = [60, 60, 60], [100, 80, 80]
    share = sharding.grant(wanted, load, most)
    after = list(load)
    for (s, t, g), x in share.items():
        after[s] -= wanted[s, t, g] * x
        after[t] += wanted[s, t, g] * x
    assert all(a <= m + 1e-6 for a, m in zip(after, most, strict=True)) and share[0, 1, 3] > share.get((2, 1, 1), 0)


def test_sharding_odd_rows(odd, none):
    rows = sharding.shard_documents(odd, 3).collect()
    check_shards(rows, 3, odd.count())
    assert sharding.shard_documents(none).count() == 0


def test_components(spark):
    import random

    r = random.Random(2)
    for n, m in ((1, 0), (30, 20), (60, 80)):
        pairs = [(r.randrange(n), r.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(100, 120)]
        got = {x.node: x.root for x in connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
        linked = {frozenset(p) for p in pairs}
        nodes = {x for p in pairs if p[0] != p[1] for x in p}
        want = classes({x: x for x in nodes}, lambda a, b: frozenset((a, b)) in linked)
        assert got == want
    assert list(itertools.islice(got, 1))
