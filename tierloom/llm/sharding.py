"""Sharding by balanced label propagation: linked rows move to the shard most of their neighbours are in, under quotas.

Rows of one group are linked with each other. Every row starts in a shard by hash. In a round each linked row looks up,
through a join with its group's counts per shard, the shard with most of its group among those with room, and asks to
move there. Moves are granted per pair of shards, largest gains first, so that no shard exceeds its quota plus a slack;
within a pair and gain class a hash decides. Rounds end when nobody wants to move, or after `rounds` (20) of them. Then counts are made exact: rows over
quota, those without neighbours in their shard first, fill the shards under quota. In the end the shards' row counts
differ by at most one, and slots number each shard's rows without gaps.

Only counts per shard and per pair of shards reach the driver (shards^2 x gain classes). A group larger than a quota
fills shards one after the other.

Cases: null group keys are a group like any other if the caller gives them one, else such rows have no neighbours; ids
are not used to tell rows apart, so they may be null or repeated; fewer rows than shards leave shards empty; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierloom.sources.staging import stage

SLOT_ROWS = 10_000  # rows that one task numbers
GAIN_CLASSES = 24


def _hash(*parts) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 30)).cast("long")


def quotas(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def grant(wanted: dict[tuple[int, int, int], int], load: list[int], most: list[int]) -> dict[tuple[int, int, int], float]:
    """Share of the wanted moves (from, to, gain class) to grant so that no shard ends above `most` (or its load now).

    Starts from all moves and takes back, shard by shard, the inflow that does not fit, smallest gains first; taking
    back inflow of one shard keeps rows in others, so this repeats until all fit. It only takes back, so it ends.
    """
    left = {k: float(n) for k, n in wanted.items()}
    while True:
        over = False
        for t in range(len(load)):
            inflow = sorted((g, s) for s, u, g in left if u == t and left[s, u, g] > 0)
            excess = load[t] + sum(left[s, t, g] for g, s in inflow) - sum(
                n for (s, _, _), n in left.items() if s == t) - max(most[t], load[t])
            for g, s in inflow:
                if excess <= 1e-6:
                    break
                back = min(excess, left[s, t, g])
                left[s, t, g] -= back
                excess -= back
                over = True
        if not over:
            return {k: n / wanted[k] for k, n in left.items() if n > 0}


def propagate(linked: DataFrame, shards: int, most: list[int], rounds: int = 20) -> DataFrame:
    """uid, key, shard after label propagation. linked: uid, key (rows that have neighbours)."""
    spark = linked.sparkSession
    now = stage(linked.select("uid", "key", (_hash("uid") % shards).cast("int").alias("shard")), "labels")
    for step in range(rounds):
        load = [0] * shards
        for r in now.groupBy("shard").agg(F.count("*").alias("n")).collect():  # one row per shard
            load[r["shard"]] = r["n"]
        room = [s for s in range(shards) if load[s] < most[s]]
        per_shard = now.groupBy("key", "shard").agg(F.count("*").alias("n"))
        # Among the shards with room: most of the group, then a shard of the group's own choice. At most `shards` each.
        liking = F.struct("n", (-F.pmod(F.xxhash64("key", "shard"), F.lit(1 << 30))).alias("tie"), "shard")
        best = per_shard.groupBy("key").agg(
            F.max(F.when(F.col("shard").isin(room), liking)).alias("best"),
            F.map_from_entries(F.collect_list(F.struct("shard", "n"))).alias("counts"))
        asked = now.join(best, "key").withColumn("own", F.col("counts")[F.col("shard")]).withColumn(
            "gain", F.col("best.n") - F.col("own"))
        tie = (-F.pmod(F.xxhash64("key", "shard"), F.lit(1 << 30)))
        better = (F.col("gain") > 0) | ((F.col("gain") == 0) & (F.col("best.tie") > tie))
        asked = stage(asked.select(
            "uid", "key", "shard", F.when(better & (F.col("best.shard") != F.col("shard")), F.col("best.shard")).alias("to"),
            F.least(F.log2(F.col("gain") + 1), F.lit(GAIN_CLASSES - 1)).cast("int").alias("class")), "moves")
        wanted = {(r["shard"], r["to"], r["class"]): r["n"] for r in asked.where("to is not null").groupBy(
            "shard", "to", "class").agg(F.count("*").alias("n")).collect()}
        if not wanted:
            break
        share = grant(wanted, load, most)
        if not share:
            break
        granted = F.broadcast(spark.createDataFrame(
            [(s, t, g, int(x * (1 << 30))) for (s, t, g), x in share.items()], "shard int, to int, class int, cut long"))
        now = stage(asked.join(granted, ["shard", "to", "class"], "left").select(
            "uid", "key", F.when(_hash("uid", F.lit(step)) < F.col("cut"), F.col("to")).otherwise(F.col("shard")).alias("shard")),
            "labels")
    return now


def numbered(rows: DataFrame, count: int) -> DataFrame:
    """rows (uid, shard, rank) with slot: from 0 within each shard, by rank and then by parts of bounded size."""
    parts = max(1, -(-count // SLOT_ROWS))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("uid", F.lit("part")), F.lit(parts)).cast("int"))
    sizes = rows.groupBy("shard", "rank", "part").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(
        Window.partitionBy("shard").orderBy("rank", "part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("shard", "rank", "part").orderBy("uid")) - 1
    return rows.withColumn("within", within).join(before.drop("n"), ["shard", "rank", "part"]).withColumn(
        "slot", F.col("before") + F.col("within"))


def _by_shard(values: list[int]) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), F.col("shard") + 1)


def _settled(rows: DataFrame, count: int, shards: int) -> DataFrame:
    """uid, shard, slot with exact quotas. rows: uid, shard (-1: anywhere), rank (0: keep, 1: movable first)."""
    quota = quotas(count, shards)
    slotted = stage(numbered(rows, count).select("uid", "shard", "slot"), "slotted")
    load = {r["shard"]: r["n"] for r in slotted.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    kept = [min(load.get(s, 0), quota[s]) for s in range(shards)]
    # What is over quota, shard by shard, and then what has no shard, in one sequence; it fills the free slots in order.
    over, start = [], 0
    for s in range(shards):
        over.append(start - kept[s])
        start += load.get(s, 0) - kept[s]
    free, first = [], 0
    for s in range(shards):
        free.append((first, s, kept[s]))
        first += quota[s] - kept[s]
    stays = (F.col("shard") >= 0) & (F.col("slot") < _by_shard(quota))
    place = F.when(F.col("shard") >= 0, F.col("slot") + _by_shard(over)).otherwise(F.col("slot") + start)
    moved = slotted.withColumn("place", F.when(~stays, place))
    target, slot = F.col("shard"), F.col("slot")
    for begin, s, used in free:  # ascending, so that the last one that begins at or before the place holds
        here = F.col("place") >= begin
        target, slot = F.when(here, F.lit(s)).otherwise(target), F.when(here, F.col("place") - begin + used).otherwise(slot)
    return moved.select("uid", target.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def assign(rows: DataFrame, shards: int = 16, slack: float = 0.05, rounds: int = 20) -> DataFrame:
    """rows (uid, key: null where the row has no group) with shard and slot; counts differ by at most one."""
    count = rows.count()
    sizes = rows.where("key is not null").groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    linked = rows.join(sizes, "key", "left_semi").select("uid", "key")
    most = [int(q * (1 + slack)) + 1 for q in quotas(count, shards)]
    labels = propagate(linked, shards, most, rounds)
    # A row stays for good where the shard has others of its group; lone rows make room first.
    together = labels.groupBy("key", "shard").agg(F.count("*").alias("n"))
    ranked = labels.join(together, ["key", "shard"]).select(
        "uid", "shard", F.when(F.col("n") > 1, 0).otherwise(1).alias("rank"))
    lone = rows.select("uid").join(labels.select("uid"), "uid", "left_anti").select(
        "uid", F.lit(-1).alias("shard"), F.lit(0).alias("rank"))
    return rows.join(_settled(ranked.unionByName(lone), count, shards), "uid")


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard; groups are equal texts, null ones like empty ones."""
    text = F.coalesce(F.col("`text`"), F.lit(""))
    raw = text.cast("binary")
    rows = stage(docs.select(
        F.col("`doc_id`").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(raw).cast("long").alias("text_crc32"), F.md5(raw).alias("key")).withColumn(
        "uid", F.monotonically_increasing_id()), "rows")
    return assign(rows, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
