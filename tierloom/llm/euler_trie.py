"""The trie of conversation prefixes, and what sharing them saves, by an Euler tour.

Every prefix of a conversation is known by a 128-bit sum over its turns of numbers drawn from a SHA-256 of place, role
and text, so prefixes come from running sums along one global order and a long conversation spans many tasks. Each node
has an arc that enters it and one that leaves it; the tour's successor of an arc follows from the first child, the next
sibling and the parent. The list of arcs is ranked by contraction: arcs are dealt to blocks, a block joins what
follows one another within it into segments, and segments are dealt anew, each drawn to its successor's block by a coin,
until one is left. Unwinding gives every arc its position and the prefix sums before it; a subtree's leaves and savings
are the differences of the sums at its two arcs. Work is in proportion to the turns; no subtree, path, group of
siblings or list is ever held by one task.

Cases: rows without conv_id take no part; null role or text counts as empty; a null turn comes first; equal turns come in
the order of the SHA-256 of role and text, and repeated rows are turns of their own; a conversation without turns (all
of them replaced) is a member of the root only; an empty table gives an empty result, without a root; further columns
are not read.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.llm.ordered import BLOCK_ROWS, blocks_for, joined_digests, scan_in_order
from tierloom.sources.staging import stage, with_size_check

MARKS = ["m0", "m1", "m2", "m3"]
KEY = ["p0", "p1", "p2", "p3"]
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def number_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, nth (from 1), digest of role and text, chars (code points of text), last."""
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.substring(F.unhex(digest), 1, 16).alias("digest"), F.length(text).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("row"))
    return scan_in_order(turns, ["conv_id"], ["turn", "digest", "row"], rows=conversations.count(), name="turns").select(
        "conv_id", "nth", "digest", "chars", "last")


def as_they_are(numbered: DataFrame) -> DataFrame:
    """conv_id, depth, digest, chars: a row of depth 0 for every conversation, then its turns."""
    roots = numbered.where("last").select("conv_id", F.lit(0).cast("long").alias("depth"), *_no_turn())
    return roots.unionByName(numbered.select("conv_id", F.col("nth").alias("depth"), "digest", "chars"))


def rebuilt(numbered: DataFrame, family: int = 100, most: int = 5) -> DataFrame:
    """As as_they_are, with the first h turns of a conversation replaced by those of the first one of its family.

    h = crc32(decimal conv_id) mod (most + 1); the family's first is conv_id - conv_id % family. All its turns if it has
    fewer than h, none if it is absent.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("long")
    first = F.col("conv_id") - F.col("conv_id") % family
    ends = numbered.where("last").select("conv_id", F.col("nth").alias("n"))
    roots = ends.select("conv_id", F.lit(0).cast("long").alias("depth"), *_no_turn())
    source = numbered.where((F.col("conv_id") % family == 0) & (F.col("nth") <= most)).select(
        F.col("conv_id").alias("first"), F.col("nth").alias("depth"), "digest", "chars")
    taken = ends.select("conv_id", first.alias("first"), h.alias("h")).join(source, "first").where("depth <= h")
    given = ends.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("first"), F.col("n").alias("n_first"))
    own = numbered.withColumn("h", h).withColumn("first", first).where("nth > h").join(
        with_size_check(stage(given, "family_sizes")), "first", "left")
    shifted = F.col("nth") - F.col("h") + F.least("h", F.coalesce("n_first", F.lit(0)))
    return roots.unionByName(taken.select("conv_id", "depth", "digest", "chars")).unionByName(
        own.select("conv_id", shifted.alias("depth"), "digest", "chars"))


def _no_turn() -> list[Column]:
    return [F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("chars")]


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, depth, chars, last; KEY: the prefix up to this depth; MARKS: what its last turn adds to KEY."""
    drawn = F.sha2(F.concat(F.col("depth").cast("string").cast("binary"), F.lit(":").cast("binary"), "digest"), 256)
    marks = [
        F.when(F.col("depth") == 0, F.lit(0)).otherwise(F.conv(F.substring(drawn, 8 * k + 1, 8), 16, 10).cast("long"))
        .cast("long").alias(m) for k, m in enumerate(MARKS)]
    marked = stage(turns.select("conv_id", "depth", "chars", *marks), "marked_turns")
    summed = scan_in_order(marked, ["conv_id"], ["depth"], sums=MARKS, name="prefixes")
    return summed.select(
        "conv_id", "depth", "chars", "last", *MARKS, *[F.col(f"{m}_upto").alias(p) for m, p in zip(MARKS, KEY, strict=True)])


def family_tree(prefix_rows: DataFrame) -> DataFrame:
    """A row per node: conv_id (smallest member) and depth, which identify it, parent_conv_id, n_convs, chars, KEY."""
    nodes = stage(prefix_rows.groupBy("depth", *KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"),
        *[F.max(m).alias(m) for m in MARKS]), "trie_nodes")
    above = [(F.col(p) - F.col(m)).alias(f"above_{p}") for p, m in zip(KEY, MARKS, strict=True)]
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"),
        *[F.col(p).alias(f"above_{p}") for p in KEY])
    # A parent with most of the children is a hot key of the left side only, which adaptive execution splits.
    return stage(
        nodes.select("conv_id", "depth", "n_convs", "chars", *KEY, *above).join(
            parents, ["depth", *[f"above_{p}" for p in KEY]], "left").select(
            "conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
            "n_convs", "chars", *KEY), "trie_tree")


def linked(tree: DataFrame) -> DataFrame:
    """tree with n_children, first_child and next_sibling (smallest members; null if none). Siblings ascend."""
    below = tree.where("depth > 0")
    kin = scan_in_order(
        below.select("parent_conv_id", "depth", "conv_id", "n_convs", "chars"), ["parent_conv_id", "depth"], ["conv_id"],
        lead=["conv_id"], name="siblings").withColumnRenamed("next_conv_id", "next_sibling")
    none = F.lit(None).cast("long")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "chars", "next_sibling"]
    root = tree.where("depth = 0").withColumn("next_sibling", none)
    children = below.groupBy("parent_conv_id", "depth").agg(
        F.count("*").alias("n_children"), F.min("conv_id").alias("first_child")).select(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"), "n_children", "first_child")
    return stage(
        kin.select(columns).unionByName(root.select(columns)).join(children, ["conv_id", "depth"], "left").fillna(
            0, ["n_children"]), "trie_links")


WEIGHTS = ["w_arcs", "w_leaves", "w_saved"]


def tour(links: DataFrame) -> DataFrame:
    """The arcs of the Euler tour: id (c, k) with k = 2 depth to enter, 2 depth + 1 to leave; succ (nc, nk); WEIGHTS."""
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    d = F.col("depth")
    inner = F.col("n_children") > 0
    enter = F.struct(
        F.col("conv_id").alias("c"), (2 * d).alias("k"),
        F.when(inner, F.col("first_child")).otherwise(F.col("conv_id")).alias("nc"),
        F.when(inner, 2 * d + 2).otherwise(2 * d + 1).alias("nk"), one.alias("w_arcs"),
        F.when(inner, zero).otherwise(one).alias("w_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("w_saved"))
    sibling = F.col("next_sibling").isNotNull()
    leave = F.struct(
        F.col("conv_id").alias("c"), (2 * d + 1).alias("k"),
        F.when(sibling, F.col("next_sibling")).otherwise(F.col("parent_conv_id")).alias("nc"),
        F.when(sibling, 2 * d).when(d > 0, 2 * d - 1).alias("nk"), one.alias("w_arcs"), zero.alias("w_leaves"),
        zero.alias("w_saved"))
    return links.select(F.explode(F.array(enter, leave)).alias("arc")).select("arc.*")


def _codes(*sides: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """One number for each pair (c, k), equal for equal pairs of any side."""
    names, c = np.unique(np.concatenate([s[0] for s in sides]), return_inverse=True)
    places, k = np.unique(np.concatenate([s[1] for s in sides]), return_inverse=True)
    code = c.astype(np.int64) * len(places) + k
    return np.split(code, np.cumsum([len(s[0]) for s in sides])[:-1])


def join_runs(block: pd.DataFrame) -> pd.DataFrame:
    """Segments (joined = False: id, succ, weights) and, for every other member of a run, joined = True with the run's
    first member as (nc, nk) and the weights before it in the run."""
    n = len(block)
    has_next = block["nc"].notna().to_numpy()
    follower = block["nc"].fillna(0).to_numpy(np.int64), block["nk"].fillna(-1).to_numpy(np.int64)
    own, succ = _codes((block["c"].to_numpy(), block["k"].to_numpy()), follower)
    order = np.argsort(own)
    at = np.minimum(np.searchsorted(own[order], succ), n - 1)
    succ_row = np.where(has_next & (own[order][at] == succ), order[at], -1)
    before = np.arange(n)  # the row before, own row if none in the block
    before[succ_row[succ_row >= 0]] = np.flatnonzero(succ_row >= 0)
    heads = before == np.arange(n)
    w = block[WEIGHTS].to_numpy(np.int64)
    offset = np.where(heads[:, None], 0, w[before])
    head = before
    while True:
        further = head[head]
        if (further == head).all():
            break
        offset = offset + offset[head]
        head = further
    tails = succ_row < 0
    out = block.copy()
    out["joined"] = ~heads
    total = np.zeros_like(w)
    total[head[tails]] = offset[tails] + w[tails]
    out[WEIGHTS] = np.where(heads[:, None], total, offset)
    run_end = np.zeros(n, dtype=np.int64)
    run_end[head[tails]] = np.flatnonzero(tails)
    for name, own_name in (("nc", "c"), ("nk", "k")):
        ahead = block[name].to_numpy()[run_end]
        out[name] = pd.array(np.where(heads, ahead, block[own_name].to_numpy()[head]), dtype="Int64")
    return out


def _join_runs_in_blocks(segments: DataFrame) -> DataFrame:
    schema = T.StructType([
        *[T.StructField(c, T.LongType()) for c in ("c", "k", "nc", "nk", *WEIGHTS)], T.StructField("joined", T.BooleanType())])
    names = schema.names

    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        block = pa.Table.from_batches(batches).to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
        for c in ("c", "k", *WEIGHTS):
            block[c] = block[c].to_numpy(np.int64)
        done = join_runs(block)
        yield from pa.Table.from_pandas(done[names], preserve_index=False).to_batches(max_chunksize=20_000)

    return segments.select("c", "k", "nc", "nk", *WEIGHTS).mapInArrow(run, schema)


def _coin(level: int, c: str, k: str) -> Column:
    return F.xxhash64(F.lit(level), c, k) % 2 == 0


def positions(arcs: DataFrame, rows: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """c, k and, under the names of WEIGHTS, the sums of the weights of all arcs before this one in the tour."""
    levels = []
    dealt = arcs.repartitionByRange(blocks_for(rows, block_rows), "c", "k")  # paths of one conversation lie together
    while True:
        done = stage(_join_runs_in_blocks(dealt), "tour_runs")
        levels.append(done)
        segments = done.where("not joined")
        left = segments.count()
        if left <= 1:
            break
        if left <= block_rows:
            dealt = segments.repartition(1)
            continue
        drawn = ~_coin(len(levels), "c", "k") & F.col("nc").isNotNull() & _coin(len(levels), "nc", "nk")
        mate = [F.when(drawn, F.col(n)).otherwise(F.col(o)) for n, o in (("nc", "c"), ("nk", "k"))]
        dealt = segments.repartition(blocks_for(left, block_rows), *mate)
    top = levels.pop()
    start = [F.when(F.col("joined"), F.col(w)).otherwise(0).alias(w) for w in WEIGHTS]
    known = top.select("c", "k", *start)
    while levels:
        level = levels.pop()
        members = level.where("joined").alias("m").join(
            known.alias("h"), (F.col("m.nc") == F.col("h.c")) & (F.col("m.nk") == F.col("h.k"))).select(
            "m.c", "m.k", *[(F.col(f"m.{w}") + F.col(f"h.{w}")).alias(w) for w in WEIGHTS])
        known = stage(known.unionByName(members), "tour_known")
    return known


def trie(turns: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A row per distinct prefix of turns (conv_id, depth, digest, chars; depth 0 once a conversation).

    conv_id (smallest member), depth, parent_conv_id, n_convs (members), n_children, n_leaves (of its subtree),
    saved_tokens (over its subtree: (members - 1) times the code points of a node's last text), ends_sha256 (of the
    ascending ids of the members that end here), enter_at and leave_at (positions of its arcs in the tour).
    """
    rows = stage(prefixes(turns), "prefix_rows")
    tree = family_tree(rows)
    links = linked(tree)
    at = positions(tour(links), 2 * links.count(), block_rows)
    even = F.col("k") % 2 == 0
    spans = at.groupBy(F.col("c").alias("conv_id"), F.floor(F.col("k") / 2).cast("long").alias("depth")).agg(
        *[F.max(F.when(even, F.col(w))).alias(f"{w}_in") for w in WEIGHTS],
        *[F.max(F.when(~even, F.col(w))).alias(f"{w}_out") for w in WEIGHTS])
    members = rows.where("last").select(*KEY, "depth", "conv_id")
    ends = joined_digests(members, [*KEY, "depth"], "conv_id", rows=members.count())
    ended = tree.select("conv_id", "depth", *KEY).join(ends, [*KEY, "depth"], "left").select(
        "conv_id", "depth", F.coalesce("sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))
    return reduce(lambda a, b: a.join(b, ["conv_id", "depth"]), [links, spans, ended]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("w_leaves_out") - F.col("w_leaves_in")).alias("n_leaves"),
        (F.col("w_saved_out") - F.col("w_saved_in")).alias("saved_tokens"), "ends_sha256",
        F.col("w_arcs_in").alias("enter_at"), F.col("w_arcs_out").alias("leave_at"))

