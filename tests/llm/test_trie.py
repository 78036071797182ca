import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from tierloom.llm import euler_trie, ordered
from tierloom.llm.queries import REGISTRY

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, rebuild=True):
    """The nodes of the trie, from whole sequences in memory."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            own[c].append(((turn is not None, turn or 0, tie), (role, text)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if rebuild else 0
        full[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        gain = (len(convs) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += gain
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(full[c]) == len(node)))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), children[node], leaves[node],
            saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0], r[1]))


def nodes(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=lambda r: (r[0], r[1]))


@pytest.fixture
def small_blocks(monkeypatch):
    """Blocks of a few rows, so that groups span many of them and the contraction takes many rounds."""
    monkeypatch.setattr(ordered, "blocks_for", lambda rows, block_rows=0: max(1, rows // 40))
    monkeypatch.setattr(euler_trie, "blocks_for", lambda rows, block_rows=0: max(1, rows // 40))


def test_trie_of_given_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert nodes(REGISTRY["op11_prefix_trie"](spark, sf)) == brute([tuple(r) for r in rows])


def test_trie_over_many_blocks(spark, small_blocks):
    r = random.Random(5)
    rows = []
    for c in range(60):
        for turn in range(r.choice([1, 2, 3, 7])):
            rows.append((c * 7, turn, r.choice("ab"), r.choice(["x", "yy"])))
    rows += [(700, t, "a", "x") for t in range(150)]  # one conversation with a third of all turns
    df = spark.createDataFrame(rows, SCHEMA)
    numbered = euler_trie.number_turns(df)
    found = euler_trie.trie(euler_trie.rebuilt(numbered), block_rows=30)
    assert nodes(found) == brute(rows)
    tour = sorted((v["enter_at"], v["leave_at"]) for v in found.collect())
    assert sorted(x for span in tour for x in span) == list(range(2 * len(tour)))
    as_is = euler_trie.trie(euler_trie.as_they_are(numbered), block_rows=30)
    assert nodes(as_is) == brute(rows, rebuild=False)


def test_trie_of_odd_rows(spark):
    rows = [
        (-101, 0, "user", "a"), (-200, None, None, None), (-200, 3, "user", "ü—你"), (5, 0, "user", "a"),
        (5, 0, "user", "a"), (5, 0, "bot", "b"), (5, None, "user", None), (None, 1, "user", "lost"), (100, 2, "", ""),
        (101, 1, "user", "a"), (102, 1, "user", "a"), (103, 9, "user", "x" * 50_000), (7, 1, "use", "ra"), (7, 2, "user", "a")]
    df = spark.createDataFrame(
        [(*r, 0, "x") for r in rows], SCHEMA + ", depth long, p0 string")
    assert nodes(euler_trie.trie(euler_trie.rebuilt(euler_trie.number_turns(df)))) == brute(rows)
    assert nodes(euler_trie.trie(euler_trie.rebuilt(euler_trie.number_turns(df.limit(0))))) == []


def test_scan_in_order_matches_plain_sums(spark, small_blocks):
    r = random.Random(1)
    rows = [(r.choice([1, 1, 1, 2, 3, 4]), i, r.randrange(100)) for i in range(300)]
    got = ordered.scan_in_order(spark.createDataFrame(rows, "g long, o long, v long"), ["g"], ["o"], ["v"], ["v"])
    expected = []
    for g in {x[0] for x in rows}:
        own, total = sorted(x for x in rows if x[0] == g), 0
        for i, x in enumerate(own):
            total += x[2]
            last = i + 1 == len(own)
            expected.append((*x, i + 1, total, None if last else own[i + 1][2], last))
    assert sorted(map(tuple, got.select("g", "o", "v", "nth", "v_upto", "next_v", "last").collect())) == sorted(expected)
