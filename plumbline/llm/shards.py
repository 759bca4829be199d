"""Sharding by a minimax contiguous partition of atomic groups (native: DataFrame operations only).

Rows with equal texts form one atomic group, null counting as the empty text. Groups are ordered
by the MD5 of their text. The driver finds the smallest capacity for which a greedy left-to-right
pass needs no more than the wanted shards, by binary search over prefix sums, and the groups are
cut there. What the driver sees is bounded: the prefix sums come as at most CELLS break points a
round, and each round looks closer only at the stretches in which a cut can fall, until the cuts
are exact. A group above the fair share of the remaining shards is a shard of its own, so that the
others stay near equal.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import body, written

#: Order blocks of the groups (a fixed number, so sums over blocks are a bounded table).
BLOCKS = 4096
#: Slices of a group's rows; a group with a third of all rows is spread over so many tasks.
SALTS = 64
#: Break points that one round brings to the driver at most.
CELLS = 32768


def greedy_cuts(breaks: list[int], capacity: int, shards: int) -> list[int] | None:
    """Cuts (prefix sums at which a shard ends) of the greedy pass, or None if it needs more shards."""
    cuts, start = [], 0
    while start < breaks[-1]:
        if len(cuts) == shards:
            return None
        k = bisect_right(breaks, start + capacity) - 1
        if k < 0 or breaks[k] <= start:
            return None
        start = breaks[k]
        cuts.append(start)
    return cuts


def smallest_capacity(breaks: list[int], shards: int) -> tuple[int, list[int]]:
    """The smallest feasible shard capacity over ordered break points, and its cuts."""
    if not breaks or breaks[-1] == 0:
        return 0, []
    low, high = -(-breaks[-1] // shards), breaks[-1]
    while low < high:
        middle = (low + high) // 2
        if greedy_cuts(breaks, middle, shards) is None:
            low = middle + 1
        else:
            high = middle
    return low, greedy_cuts(breaks, low, shards)


def exact_cuts(groups: DataFrame, total: int, shards: int) -> list[int]:
    """Cuts of the minimax partition of `groups` (column `upto`: prefix sum with the group itself)."""
    windows, known = [(0, total)], {total}
    while total:
        width = sum(b - a for a, b in windows)
        unit = max(1, -(-width // CELLS))
        inside = F.lit(False)
        for a, b in windows:
            inside = inside | ((F.col("upto") > a) & (F.col("upto") <= b))
        cells = (
            groups.where(inside)
            .groupBy(F.floor((F.col("upto") - 1) / F.lit(unit)).alias("cell"))
            .agg(F.min("upto").alias("first"), F.max("upto").alias("last"))
        )
        found = [(r["first"], r["last"]) for r in cells.collect()]
        known.update(x for pair in found for x in pair)
        breaks = sorted(known)
        capacity, cuts = smallest_capacity(breaks, shards)
        if unit == 1:
            return cuts
        # With all break points the capacity is smaller by a cell at most for each shard before a
        # cut, so every exact cut lies in one of these stretches.
        reach = unit * (shards + 1)
        low = greedy_reach(breaks, max(1, capacity - reach), shards)
        windows = merged([(max(0, a - reach), min(total, b + reach)) for a, b in zip(low, cuts, strict=False)])
        if sum(b - a for a, b in windows) >= width:
            return cuts
    return []


def greedy_reach(breaks: list[int], capacity: int, shards: int) -> list[int]:
    """How far each shard gets with a capacity that may be too small."""
    ends, start = [], 0
    for _ in range(shards):
        k = bisect_right(breaks, start + capacity) - 1
        start = breaks[k] if k >= 0 and breaks[k] > start else start
        ends.append(start)
    return ends


def merged(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(windows):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: its id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null).

    Sizes of shards are near equal in bytes; equal texts share a shard. Null texts count as empty
    (size 1). Repeated rows and repeated ids each keep a slot of their own; other columns are not
    looked at, so extra ones with any name are harmless. An empty table gives an empty result;
    with fewer groups than shards the last shards stay empty.
    """
    text = body(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(text.cast("binary"))).alias("g"),
    ).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    parts = rows.groupBy("g", "salt").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size"))
    parts = written(parts, "shard-parts")
    groups = (
        parts.groupBy("g")
        .agg(F.sum("n").alias("n"), (F.sum("n") * F.first("size")).alias("bytes"))
        .withColumn("block", F.conv(F.substring(F.hex("g"), 1, 3), 16, 10).cast("int"))
    )
    groups = written(groups, "shard-groups")
    largest = groups.orderBy(F.desc("bytes"), "g").limit(shards).collect()
    rest = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("b")).first()["b"]
    alone = []
    for r in largest:
        left = shards - len(alone)
        if left > 1 and r["bytes"] * left > rest and rest > r["bytes"]:
            alone.append(bytes(r["g"]))
            rest -= r["bytes"]
        else:
            break

    # Prefix sums in two steps: within a block, and over the bounded table of blocks.
    lone = F.coalesce(F.col("g").isin([F.lit(g) for g in alone]), F.lit(False)) if alone else F.lit(False)
    groups = groups.select("g", "n", "bytes", "block", lone.alias("lone"))
    some = F.when(F.col("lone"), 0)
    blocks = groups.groupBy("block").agg(F.sum(some.otherwise(F.col("bytes"))).alias("b"), F.sum(some.otherwise(F.col("n"))).alias("r"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("block", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"), F.coalesce(F.sum("r").over(before), F.lit(0)).alias("r0"))
    within = Window.partitionBy("block").orderBy("g").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prefix = (
        groups.select("*", F.sum(some.otherwise(F.col("bytes"))).over(within).alias("b1"), F.sum(some.otherwise(F.col("n"))).over(within).alias("r1"))
        .join(F.broadcast(blocks), "block")  # BLOCKS rows at most
        .select("g", "lone", (F.col("b0") + F.col("b1")).alias("upto"), (F.col("r0") + F.col("r1") - F.when(F.col("lone"), 0).otherwise(F.col("n"))).alias("rows_before"))
    )
    prefix = written(prefix, "shard-prefix")
    cuts = exact_cuts(prefix.where(~F.col("lone")), rest, shards - len(alone))

    number = F.lit(0)
    for cut in cuts[:-1]:
        number = number + (F.col("upto") > cut).cast("int")
    for k, g in enumerate(alone):
        number = F.when(F.col("g") == F.lit(g), shards - 1 - k).otherwise(number)
    placed = prefix.withColumn("shard", number.cast("int"))
    starts = {r["shard"]: r["s"] for r in placed.where(~F.col("lone")).groupBy("shard").agg(F.min("rows_before").alias("s")).collect()}
    start = F.lit(0)
    for k, s in starts.items():
        start = F.when(F.col("shard") == k, s).otherwise(start)
    placed = placed.select("g", "shard", F.when(F.col("lone"), 0).otherwise(F.col("rows_before") - start).cast("long").alias("first"))

    in_group = Window.partitionBy("g").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    seats = parts.select("g", "salt", F.coalesce(F.sum("n").over(in_group), F.lit(0)).alias("skip")).join(placed, "g")
    seats = seats.select("g", "salt", "shard", (F.col("first") + F.col("skip")).alias("base"))
    turn = Window.partitionBy("g", "salt").orderBy("doc_id")
    return rows.join(seats, ["g", "salt"]).select(
        "doc_id",
        "size",
        F.col("text_crc32").cast("long"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("base") + F.row_number().over(turn) - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_sharding(spark, sf_dir: str) -> DataFrame:
    from plumbline.llm.common import table

    return shard(table(spark, sf_dir, "documents"))
