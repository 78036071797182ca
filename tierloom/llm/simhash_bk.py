"""SimHash near-duplicates through BK-trees: fingerprints, links within a Hamming radius, components.

Fingerprints are sharded by bits they agree in: of radius + 1 blocks at least one is equal for any linked pair. A shard
that is still large is sharded again by its other bits, until its tree is of bounded size whatever the data: with 13
free bits left it has at most 8,192 different fingerprints. Each shard becomes a BK-tree (children keyed by the Hamming
distance to their parent); a search follows only edges whose distance differs from its own by at most the radius. A
shard's tree goes to the task that searches the shard, not to all tasks, since all trees together grow with the data.

For whole documents `keep_one` links texts by the similarity of their shingle sets: fingerprints of these go to shards by
equal least hashes, the shard's BK-tree finds candidates within a wider radius, and the sets themselves decide. Shards
of many texts are compared block against block, each pair of blocks in its own task.

Cases: a null, empty or wordless text has fingerprint zero and is linked like any other; fewer words than a shingle
make one shingle; repeated rows and ids give a row each; components of null ids only have a null component_id; an empty
table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import map_texts, named_again, neutral
from tierloom.llm.components import connected_components
from tierloom.sources.staging import stage

SEED = 42
_BLOCK = 1 << 15  # shingles whose bits are counted at a time


def shingle_hashes(text: str, width: int) -> list[int]:
    words = text.encode().lower().split()  # ASCII letters and ASCII white space only
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[s:e], SEED) for s, e in zip(starts[:1 - width].tolist(), ends[width - 1:].tolist(), strict=True)]


def fingerprint(text: str, width: int = 3) -> int:
    """Bit i is set if it is in more than half of the shingle hashes. As signed 64-bit integer."""
    hashes = np.array(shingle_hashes(text, width), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), _BLOCK):
        bits = np.unpackbits(hashes[i:i + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` and fp of every row of docs."""
    return map_texts(docs, [("fp", "long")], lambda texts: [[fingerprint(t, width) for t in texts]], keep)


class BkTree:
    """Children of a node by their Hamming distance to it."""

    __slots__ = ("root",)

    def __init__(self):
        self.root: tuple[int, dict] | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        node = self.root
        while True:
            d = (node[0] ^ value).bit_count()
            child = node[1].get(d)
            if child is None:
                node[1][d] = (value, {})
                return
            node = child

    def within(self, value: int, radius: int) -> Iterator[int]:
        """The values of the tree at most `radius` bits from `value`."""
        todo = [self.root] if self.root else []
        while todo:
            own, children = todo.pop()
            d = (own ^ value).bit_count()
            if d <= radius:
                yield own
            for k in range(d - radius, d + radius + 1):
                if k in children:
                    todo.append(children[k])


def shard_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect what is connected among the different values of one shard: at most one per value."""
    if len(values) == 2:
        return [tuple(values)] if (values[0] ^ values[1]).bit_count() <= radius else []
    tree, parent, links = BkTree(), {}, []

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for value in values:
        parent[value] = value
        for other in tree.within(value, radius):
            a, b = top(other), top(value)
            if a != b:
                parent[b] = a
                links.append((other, value))
        tree.add(value)
    return links


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _blocks(mask: int, parts: int) -> list[int]:
    """The bits outside `mask` in `parts` runs of almost equal size; each with `mask`."""
    free = [i for i in range(64) if not mask >> i & 1]
    cut = [len(free) * k // parts for k in range(parts + 1)]
    return [mask | sum(1 << i for i in free[a:z]) for a, z in zip(cut, cut[1:], strict=False)]


FREE_BITS = 13


def shard_masks(radius: int) -> dict[int, list[int]]:
    """For each mask the masks that shard it further; 0 is the whole. Masks with at most FREE_BITS free bits end."""
    found, todo = {}, [0]
    while todo:
        mask = todo.pop()
        if 64 - mask.bit_count() > FREE_BITS:
            found[mask] = [m for m in _blocks(mask, radius + 1) if m != mask]
            todo += found[mask]
    return found


def links(nodes: DataFrame, radius: int = 2, tree_size: int = 1024) -> DataFrame:
    """u, v: links between the different values of nodes.fp that connect what lies within the radius.

    tree_size: shards above it are sharded further, while they have more than FREE_BITS free bits.
    """
    spark = nodes.sparkSession
    masks = shard_masks(radius)
    # A few hundred rows, set by the radius alone.
    table = F.broadcast(spark.createDataFrame(
        [(_signed(m), _signed(c)) for m, below in masks.items() for c in below], "mask long, child long"))

    def shard(rows):
        return rows.join(table, "mask").select(
            F.col("child").alias("mask"), F.col("fp").bitwiseAND(F.col("child")).alias("part"), "fp").distinct()

    rows, ready = shard(nodes.select(F.lit(0).cast("long").alias("mask"), "fp")), None
    while True:
        large = rows.groupBy("mask", "part").agg(F.count("*").alias("n")).where(F.col("n") > tree_size).join(
            table.select("mask").distinct(), "mask", "left_semi").select("mask", "part")
        large = stage(large, "large-shards")
        more = not large.isEmpty()
        done = rows.join(large, ["mask", "part"], "left_anti") if more else rows
        ready = done if ready is None else ready.unionByName(done)
        if not more:
            break
        rows = stage(shard(rows.join(large, ["mask", "part"], "left_semi")), "shards")

    def search(batches):
        key, values = None, []
        for batch in batches:
            out: list[tuple[int, int]] = []
            mask, part = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            fp = (batch.column(2).to_numpy().view(np.uint64)).tolist()
            cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (part[1:] != part[:-1])) + 1
            for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(fp)], strict=True):
                if a == z:
                    continue
                if key != (mask[a], part[a]):
                    if len(values) > 1:
                        out += shard_links(values, radius)
                    key, values = (mask[a], part[a]), []
                values += fp[a:z]
            yield _pairs(out)
        if len(values) > 1:
            yield _pairs(shard_links(values, radius))

    return ready.repartition("mask", "part").sortWithinPartitions("mask", "part", "fp").mapInArrow(search, "u long, v long")


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    array = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ascontiguousarray(array[:, 0])), pa.array(np.ascontiguousarray(array[:, 1]))], names=["u", "v"])


def fingerprint_classes(marked: DataFrame, radius: int = 2) -> DataFrame:
    """fp, root for every fingerprint that is linked to another one; marked has a column fp."""
    nodes = stage(marked.select("fp").distinct(), "fingerprints")
    return connected_components(links(nodes, radius))


def with_root(marked: DataFrame, classes: DataFrame) -> DataFrame:
    """marked with root, the class of its fingerprint; fingerprints without links are their own class."""
    return marked.join(classes.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id of those reachable by links)."""
    marked = stage(fingerprints(docs, width), "marked")
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = stage(with_root(least, fingerprint_classes(marked, radius)), "rooted")
    component = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = rooted.select("fp", "root").join(component, "root").select("fp", "component_id")
    return marked.join(of_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# Near-duplicates by similarity: the trees find candidates, the shingle sets decide.

SLOTS = 4
_SLOT_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)
# At a similarity of 0.8 fingerprints of shingle sets differ in about 10 bits (standard deviation 3).
SIMILAR_RADIUS = 20


def sketch(text: str, width: int) -> tuple[int, int, list[int], bytes]:
    """Digest of the set of shingles, its fingerprint, its least mixed hash in each slot, the sorted 32-bit hashes."""
    hashes = np.unique(np.array(shingle_hashes(text, width), dtype="<u8"))
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), _BLOCK):
        ones += np.unpackbits(hashes[i:i + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int32)
    fp = int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])
    slots = []
    for seed in _SLOT_SEEDS:
        mixed = (hashes ^ seed) * seed
        slots.append(int((mixed ^ (mixed >> np.uint64(31))).view(np.int64).min()) if len(hashes) else 0)
    return xxhash.xxh64_intdigest(hashes.tobytes(), SEED), fp, slots, np.unique(hashes.astype(np.uint32)).tobytes()


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted arrays without repeats."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


class SimilarShard:
    """Texts of one shard: BK-trees of fingerprints find candidates, their shingle sets confirm links.

    Texts already connected are not compared again. Every text stays: above `tree_size` texts a further tree begins, and
    all trees are searched.
    """

    def __init__(self, least: float, radius: int, tree_size: int = 4096):
        self.least, self.radius, self.tree_size = least, radius, tree_size
        self.parent: dict[int, int] = {}
        self.trees: list[tuple[BkTree, dict[int, list[int]]]] = []
        self.sets: dict[int, np.ndarray] = {}

    def top(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def put(self, node: int, fp: int, shingles: np.ndarray) -> None:
        self.parent.setdefault(node, node)
        if len(self.sets) % self.tree_size == 0:
            self.trees.append((BkTree(), {}))
        tree, at = self.trees[-1]
        if fp in at:
            at[fp].append(node)
        else:
            at[fp] = [node]
            tree.add(fp)
        self.sets[node] = shingles

    def links(self, node: int, fp: int, shingles: np.ndarray) -> list[tuple[int, int]]:
        """Links of a text to classes of those put in."""
        self.parent[node], links = node, []
        size = len(shingles)
        for tree, at in self.trees:
            for near in tree.within(fp, self.radius):
                for other in at[near]:
                    a, b = self.top(other), self.top(node)
                    if a == b:
                        continue
                    own = self.sets[other]
                    few, many = min(size, len(own)), max(size, len(own))
                    if few >= self.least * many and similarity(own, shingles) >= self.least:
                        self.parent[b] = a
                        links.append((other, node))
        return links

    def add(self, node: int, fp: int, shingles: np.ndarray) -> list[tuple[int, int]]:
        """Links of the new text to classes of earlier ones."""
        if node in self.parent:
            return []
        found = self.links(node, fp, shingles)
        self.put(node, fp, shingles)
        return found


def similar_links(
    nodes: DataFrame, sets: DataFrame, least: float, radius: int = SIMILAR_RADIUS, shard_size: int = 2048,
    shard_bytes: int = 64 << 20,
) -> DataFrame:
    """u, v: links that connect the nodes of equal classes. nodes: node, uid, fp, slots, bytes (of the set; one row per
    node; staged); sets: uid, shingles. The sets travel once for each shard or pair of blocks.

    Nodes with an equal slot share a shard (at a similarity of 0.8, 99.8 % of the pairs have one). Shards of more than
    `shard_size` nodes or `shard_bytes` of sets are dealt into blocks of about that many, and every pair of blocks is compared in its own task:
    no pair is lost, but the work grows with the square of such a shard.
    """
    rows = nodes.select("node", "bytes", F.explode(F.array(*[
        F.xxhash64(F.lit(1 << i), F.col("slots")[i]) for i in range(SLOTS)])).alias("key")).distinct()
    sizes = stage(rows.groupBy("key").agg(
        F.count("*").alias("n"), F.sum("bytes").alias("bytes")).where("n > 1"), "shard-sizes")
    blocks = F.ceil(F.greatest(F.col("n") / shard_size, F.col("bytes") / shard_bytes)).cast("int")
    ready = rows.drop("bytes").join(sizes, "key").select("key", "node", blocks.alias("blocks")).select(
        "key", "node", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("own"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    ready = ready.select(
        "key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "node")

    def search(batches):
        cell, shard = None, None
        for batch in batches:
            key, a, b, side, node, fp = (batch.column(i).to_numpy() for i in range(6))
            fp = fp.view(np.uint64).tolist()
            out = []
            for i, (now, n, shingles) in enumerate(zip(
                    zip(key.tolist(), a.tolist(), b.tolist(), strict=True), node.tolist(), batch.column(6), strict=True)):
                if now != cell:
                    cell, shard = now, SimilarShard(least, radius)
                own = np.frombuffer(shingles.as_py(), dtype=np.uint32)
                if now[1] == now[2]:
                    out += shard.add(n, fp[i], own)
                elif side[i]:
                    out += shard.links(n, fp[i], own)
                else:
                    shard.put(n, fp[i], own)
            u, v = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    placed = ready.join(nodes.select("node", "uid", "fp"), "node").join(sets, "uid").select(
        "key", "a", "b", "side", "node", "fp", "shingles")
    return placed.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b", "side", "node").mapInArrow(
        search, "u long, v long")


def keep_one(docs: DataFrame, width: int = 5, least: float = 0.8) -> DataFrame:
    """docs with one row of each class of similar texts: that of the smallest doc_id (null last), of equal ids the
    first read. Texts are linked if the Jaccard similarity of their shingle sets is at least `least`."""
    plain = neutral(docs)

    def work(texts):
        digest, fp, slots, shingles = zip(*[sketch(t, width) for t in texts], strict=True)
        return np.array(digest, dtype=np.uint64).view(np.int64), fp, slots, shingles

    # The rows go to one table, the sketches to another: the text is written once and shuffled once, at the end.
    rows = stage(plain.withColumn("uid", F.monotonically_increasing_id()), "documents")
    sketches = stage(map_texts(
        rows, [("node", "long"), ("fp", "long"), ("slots", "array<long>"), ("shingles", "binary")], work,
        ("uid", "doc_id")), "sketches")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")
    best = sketches.groupBy("node").agg(F.min(rank).alias("best"))
    nodes = stage(sketches.select("node", "uid", "fp", "slots", F.octet_length("shingles").alias("bytes")).join(
        best.select("node", F.col("best.uid").alias("uid")), ["node", "uid"], "left_semi"), "nodes")
    classes = connected_components(similar_links(nodes, sketches.select("uid", "shingles"), least))
    rooted = best.join(classes, "node", "left").withColumn("root", F.coalesce("root", "node"))
    kept = rooted.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.uid").alias("uid"))
    return named_again(rows.join(kept, "uid", "left_semi"), docs)
