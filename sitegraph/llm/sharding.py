"""Shards of equal row counts that keep linked documents together (DataFrame functions only).

Documents with equal texts are linked. Labels (shards) spread along the links by balanced label
propagation: in each round a group's members ask to move to the shard that holds most of the group,
and a shard grants what its quota and what leaves it in the same round allow, so that cells can trade
places. The state of the rounds is not documents but cells: the
members of a group that began in one shard move as one, so that a group has SHARDS cells at most,
however many documents it has, and a group larger than a shard fills several.

Law `rows`: the shards' counts differ by one at most. Documents that no link holds are the ballast:
whatever overflows a shard's count, those first, fills the shards with room.

Defined results: a null text is empty; all empty texts are one group; rows that repeat are rows of
their own; null ids are ids like others; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import only, read_table, stage_table

SHARDS, ROUNDS = 16, 10
#: Rows of one shard that one task numbers, about; hashed classes in which moves are granted.
BUCKET_ROWS, CLASSES = 2048, 64
#: A shard may be lent its quota's SLACK-th part while cells are exchanged.
SLACK = 128


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and g, the key of the group of equal texts; long texts end here."""
    text = F.coalesce("text", F.lit(""))
    return only(docs, "doc_id", "text").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text, 256).alias("g"),
    )


def start_shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")


def grants(wishes: DataFrame, left: dict[int, int], slack: int) -> DataFrame:
    """Of wishes (g, begin, shard, n, target) those that fit, larger cells first.

    Wishes are summed in classes (shard, target, size by powers of two, hash of the group), so many at
    most whatever the input, and a class is granted as a whole. What leaves a shard makes room in
    it, so opposite moves, or moves in a ring, are granted together; slack is lent until they meet.
    """
    spark = wishes.sparkSession
    wishes = wishes.withColumn("power", F.floor(F.log2("n")).cast("int")).withColumn("class", F.pmod(F.xxhash64("g"), F.lit(CLASSES)))
    keys = ["shard", "target", "power", "class"]
    sums = wishes.groupBy(*keys).agg(F.sum("n").alias("n")).collect()
    waiting, left, granted = sorted(sums, key=lambda r: (-r["power"], r["class"], r["shard"], r["target"])), dict(left), []
    while waiting:
        later = []
        for r in waiting:
            if left[r["target"]] + slack >= r["n"]:
                left[r["target"]] -= r["n"]
                left[r["shard"]] += r["n"]
                granted.append(tuple(r[k] for k in keys))
            else:
                later.append(r)
        if len(later) == len(waiting):
            break
        waiting = later
    if not granted:
        return wishes.limit(0).drop("power", "class")
    table = spark.createDataFrame(granted, "shard int, target int, power int, class long")
    return wishes.join(F.broadcast(table), keys, "left_semi").drop("power", "class")


def settle(cells: DataFrame, quota: dict[int, int], slack: int, rounds: int) -> DataFrame:
    """cells (g, begin, n) to (g, begin, shard, n) within quotas, but for slack.

    A cell asks for the shard that holds most of its group among those that hold more of it than its
    own and could take it; equal shards go by a hash of group and shard, so that all of a group ask for
    the same one and no two swap for ever. Where a shard holds too much, groups ask for one with room.
    """
    state = stage_table(cells.select("g", "begin", F.col("begin").alias("shard"), "n"), "cells")
    for _ in range(rounds):
        held = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        left = {s: q - held.get(s, 0) for s, q in quota.items()}
        roomy = [s for s, n in left.items() if n > slack]
        of = lambda d: F.create_map(*[F.lit(x) for s, n in d.items() for x in (s, n)])
        space, size = of(left), of(quota)
        tie = lambda shard: F.xxhash64("g", shard)
        here = state.groupBy("g", "shard").agg(F.sum("n").alias("members"))
        there = here.select("g", F.col("shard").alias("target"), F.col("members").alias("most"))
        more = F.struct("most", tie("target")) > F.struct("members", tie("shard"))
        # Small cells may be exchanged, so only the quota bounds them; large ones need room.
        fits = (space[F.col("target")] >= F.col("n")) | ((F.col("n") <= slack) & (size[F.col("target")] > slack) & (space[F.col("target")] >= -slack))
        pressed = space[F.col("shard")] < -slack
        other = F.col("target") != F.col("shard")
        wishes = (
            state.join(here, ["g", "shard"]).join(there, "g").where(other & fits & (more | pressed))
            .groupBy("g", "begin", "shard", "n").agg(F.max_by("target", F.struct("most", tie("target"))).alias("target"))
        )
        if roomy and any(n < -slack for n in left.values()):
            anywhere = F.element_at(F.array(*[F.lit(s) for s in roomy]), (F.pmod(F.xxhash64("g"), F.lit(len(roomy))) + 1).cast("int"))
            asked = wishes.select("g", "begin")
            wishes = wishes.unionByName(state.where(pressed).join(asked, ["g", "begin"], "left_anti").withColumn("target", anywhere))
        moved = stage_table(grants(stage_table(wishes, "wishes"), left, slack).select("g", "begin", "target"), "moves")
        if moved.isEmpty():
            break
        state = stage_table(state.join(moved, ["g", "begin"], "left").select("g", "begin", F.coalesce("target", "shard").alias("shard"), "n"), "cells")
    return state


def propagate(cells: DataFrame, quota: int, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """cells (g, begin, n) to (g, begin, shard): where each cell's members go. Groups with cells too
    large to be exchanged are settled first, the others in what these leave."""
    slack = max(1, quota // SLACK)
    heavy = cells.groupBy("g").agg(F.max("n").alias("top")).where(F.col("top") > slack).select("g")
    large = settle(cells.join(heavy, "g", "left_semi"), {s: quota for s in range(shards)}, 0, rounds)
    held = {r["shard"]: r["n"] for r in large.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    small = settle(cells.join(heavy, "g", "left_anti"), {s: quota - held.get(s, 0) for s in range(shards)}, slack, rounds)
    return large.unionByName(small).select("g", "begin", "shard")


def numbered(rows: DataFrame, by: list[str], order: list[str], total: int, name: str) -> DataFrame:
    """Adds name: the place of each row, from 0, among those of equal by; order's first column sorts
    before the rest, which only break ties within hashed buckets of bounded size."""
    buckets = max(1, total // (BUCKET_ROWS * SHARDS))
    lead, *rest = order
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(*rest), F.lit(buckets)))
    keys = [*by, lead, "bucket"]
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("rows_here"))
    before = Window.partitionBy(*by).orderBy(lead, "bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(*keys, F.coalesce(F.sum("rows_here").over(before), F.lit(0)).alias("first_here"))
    within = F.row_number().over(Window.partitionBy(*keys).orderBy(*rest)) - 1
    out = rows.withColumn("within", within).join(firsts, keys)
    return out.withColumn(name, F.col("first_here") + F.col("within")).drop("bucket", "within", "first_here")


def balanced_shards(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row."""
    spark = docs.sparkSession
    rows = stage_table(digests(docs).withColumn("begin", start_shard(shards)), "digests")
    cells = rows.groupBy("g", "begin").agg(F.count("*").alias("n"))
    sizes = cells.groupBy("g").agg(F.sum("n").alias("copies"))
    total = rows.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    linked = cells.join(sizes.where("copies > 1").select("g"), "g", "left_semi")
    places = propagate(linked, quota[-1], shards, rounds)
    wanted = rows.join(places.select("g", "begin", F.col("shard").alias("moved")), ["g", "begin"], "left").select(
        "doc_id", "size", "text_crc32", "g",
        F.coalesce("moved", "begin").alias("shard"),
        F.isnull("moved").cast("int").alias("ballast"),
    )
    placed = stage_table(numbered(wanted, ["shard"], ["ballast", "doc_id", "text_crc32", "size"], total, "slot"), "placed")
    limit = F.create_map(*[F.lit(x) for s in range(shards) for x in (s, quota[s])])[F.col("shard")]
    held = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    # The overflow of all shards, numbered through, fills the free slots in the order of the shards.
    free, at = [], 0
    for s in range(shards):
        have = min(held.get(s, 0), quota[s])
        if have < quota[s]:
            free.append((at, at + quota[s] - have, s, have - at))
            at += quota[s] - have
    over = {s: max(0, held.get(s, 0) - quota[s]) for s in range(shards)}
    first = {s: sum(over[t] for t in range(s)) for s in range(shards)}
    base = F.create_map(*[F.lit(x) for s in range(shards) for x in (s, first[s] - quota[s])])[F.col("shard")]
    spill = F.when(F.col("slot") >= limit, F.col("slot") + base)
    gaps = spark.createDataFrame(free or [(0, 0, 0, 0)], "lo long, hi long, to int, shift long")
    out = placed.withColumn("spill", spill).join(
        F.broadcast(gaps), (F.col("spill") >= F.col("lo")) & (F.col("spill") < F.col("hi")), "left"
    )
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.coalesce("to", "shard").alias("shard"),
        F.coalesce(F.col("spill") + F.col("shift"), F.col("slot")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_label_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_shards(read_table(spark, sf_dir, "documents"))
