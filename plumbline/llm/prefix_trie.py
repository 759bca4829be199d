"""Prefix trie of conversations, from a Cartesian tree over the sorted conversations' common prefixes.

    classes   Conversations of equal turns are one class, with its members' number, smallest id and the
              digest of all ids. A turn is a 128-bit digest, so conversations are arrays of digests; any
              order of them that keeps equal prefixes together will do.
    lines     The sorted classes give the line LCP_0, L_0, LCP_1, L_1, ...: what a class shares with the
              one before it (-1 for the first), and its own length.
    nodes     A place's nearest smaller values on both sides bound the classes that share its value's
              prefix. They are found in blocks of the line, each for itself; where one lies outside its
              block, the blocks' minima (BLOCKS at most) name the block that has it, and the records of
              that block the place. Places of equal value and left bound are one node.
    depths    Between its parent's depth and its own a node stands for one trie node at each depth.
    intervals A node's members, leaves and bytes are differences of running sums over the classes, its
              smallest id a least value of its interval: within a block, or of the blocks' ends and the
              blocks between.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import dealt, done, small_batches, table, written

#: Blocks of the line at most, and classes of a block at least.
BLOCKS, CLASSES = 4096, 256
#: Ids that are put into one piece of text before a class's ids are hashed.
PIECE = 4096


def digest(x: Column) -> Column:
    """128 bits of SHA-256."""
    return F.unhex(F.substring(F.sha2(x, 256), 1, 32))


def conversations(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(c, ks, bs): each conversation's turns in order, as digests and UTF-8 lengths of the texts."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    rows = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("c"), "turn", digest(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("k"), F.octet_length(text).cast("long").alias("b")
    )
    ordered = F.array_sort(F.collect_list(F.struct("turn", "k", "b")))  # null turns come first
    return rows.groupBy("c").agg(ordered.alias("ts")).select("c", F.col("ts.k").alias("ks"), F.col("ts.b").alias("bs"))


def rebuilt(convs: DataFrame) -> DataFrame:
    """convs, with the first h turns from conversation c - c % 5, and its own from behind them; h = crc32(c) % 9."""
    h = (F.crc32(F.col("c").cast("string")) % 9).cast("int")
    heads = convs.where(F.col("c") % 5 == 0).select(F.col("c").alias("from"), F.slice("ks", 1, 8).alias("hk"), F.slice("bs", 1, 8).alias("hb"))
    own = convs.withColumn("h", h).withColumn("from", F.col("c") - F.col("c") % 5)
    joined = own.join(heads, "from", "left")
    put = lambda head, tail: F.concat(F.coalesce(F.slice(head, F.lit(1), F.col("h")), F.slice(tail, 1, 0)), F.slice(tail, F.col("h") + 1, F.greatest(F.size(tail) - F.col("h"), F.lit(0))))
    return joined.select("c", put("hk", F.col("ks")).alias("ks"), put("hb", F.col("bs")).alias("bs"))


def id_digests(members: DataFrame) -> DataFrame:
    """(cls, ends): SHA-256 of each class's ids, in order, joined by commas.

    Ids are sorted in parts of about equal size, whatever their classes, and put into pieces of text; a
    class's pieces then run through one hash in order, without ever being in memory together.
    """

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, ids, out = None, [], []
        for b in batches:
            for cls, c in zip(b["cls"], b["c"], strict=True):
                if cls != now or len(ids) == PIECE:
                    if ids:
                        out.append((now, ids[0], ",".join(map(str, ids))))
                    now, ids = cls, []
                ids.append(c)
            yield pd.DataFrame(out, columns=["cls", "first", "ids"])
            out = []
        if ids:
            yield pd.DataFrame([(now, ids[0], ",".join(map(str, ids)))], columns=["cls", "first", "ids"])

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, sha, out = None, None, []
        for b in batches:
            for cls, ids in zip(b["cls"], b["ids"], strict=True):
                if cls == now:
                    sha.update(b",")
                else:
                    if now is not None:
                        out.append((now, sha.hexdigest()))
                    now, sha = cls, hashlib.sha256()
                sha.update(ids.encode())
            yield pd.DataFrame(out, columns=["cls", "ends"])
            out = []
        if now is not None:
            yield pd.DataFrame([(now, sha.hexdigest())], columns=["cls", "ends"])

    rows = members.select("cls", "c").repartitionByRange("cls", "c").sortWithinPartitions("cls", "c").mapInPandas(pieces, "cls binary, first long, ids string")
    return rows.repartition("cls").sortWithinPartitions("cls", "first").mapInPandas(hashed, "cls binary, ends string")


def shared(a: str, b: str) -> Column:
    """Length of the common prefix of two arrays, neither of which is the other."""
    return (F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False) - 1).cast("int")


def line(classes: DataFrame) -> tuple[DataFrame, int]:
    """Sorted classes with their index j, lcp with the class before (-1 for the first), and up (that class is its prefix); their number."""
    spot = [F.spark_partition_id().alias("p"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("i")]
    rows = written(classes.orderBy("ks").select("*", *spot), "sorted-classes")
    inside = Window.partitionBy("p").orderBy("i")
    ends = rows.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.max_by("ks", "i").alias("last"))
    parts = Window.orderBy("p")  # a row for each part of the sort
    starts = ends.select("p", (F.sum("n").over(parts) - F.col("n")).alias("start"), F.lag("last").over(parts).alias("end"))
    out = rows.withColumn("before", F.lag("ks").over(inside)).join(F.broadcast(starts), "p")
    out = out.withColumn("before", F.coalesce("before", "end"))
    lcp = F.coalesce(shared("before", "ks"), F.lit(-1))
    out = out.select((F.col("start") + F.col("i")).alias("j"), "cls", "n", "least", "ks", "bs", lcp.alias("lcp"), (lcp == F.size("before")).alias("up"))
    out = written(out.withColumn("up", F.coalesce("up", F.lit(False))), "line")
    done(rows)
    return out, out.count()


def nearest(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the nearest smaller values to the left (-1: none) and right (len: none)."""
    n = len(values)
    left, right, stack = np.full(n, -1, np.int64), np.full(n, n, np.int64), []
    for k, v in enumerate(values.tolist()):
        while stack and values[stack[-1]] > v:
            right[stack.pop()] = k
        # Equal values share their left bound.
        left[k] = -1 if not stack else stack[-1] if values[stack[-1]] < v else left[stack[-1]]
        stack.append(k)
    return left, right


def least_of(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Least values of values[start:end], each at least one long, by tables of powers of two."""
    rows, width = [values], 1
    while 2 * width <= len(values):
        rows.append(np.minimum(rows[-1][:-width], rows[-1][width:]))
        width *= 2
    out = np.empty(len(start), np.int64)
    level = np.frexp((end - start).astype(float))[1] - 1
    for k in np.unique(level):
        at = level == k
        out[at] = np.minimum(rows[k][start[at]], rows[k][end[at] - (1 << int(k))])
    return out


PLACES = "block long, pos long, v int, l long, lv int, r long, rv int, least long"
#: Running sums of a class in its block (to be added to the sums of the blocks before): members, their bytes, new bytes, classes that have their prefix before them.
SUMS = ["n", "nb", "nu", "up"]
SPINE = "block long, j long, " + ", ".join(f"{c} long" for c in SUMS) + ", pre long, suf long"


def block_places(b: pd.DataFrame) -> pd.DataFrame:
    """Places of one block with what the block itself says of them; l, r, least are null where it doesn't."""
    b = b.sort_values("j")
    j, mins = b["j"].to_numpy(), b["least"].to_numpy()
    v = np.column_stack([b["lcp"].to_numpy(), b["size"].to_numpy()]).ravel().astype(np.int64)
    left, right = nearest(v)
    l_in, r_in = left >= 0, right < len(v)
    both = l_in & r_in
    least = np.zeros(len(v), np.int64)
    least[both] = least_of(mins, left[both] // 2, right[both] // 2)
    base = 2 * j[0]
    show = lambda x, ok: pd.arrays.IntegerArray(np.asarray(x, np.int64), ~ok)
    at = lambda x: v[np.clip(x, 0, len(v) - 1)]
    return pd.DataFrame({"block": b["block"].iloc[0], "pos": base + np.arange(len(v)), "v": v, "l": show(base + left, l_in), "lv": show(at(left), l_in), "r": show(base + right, r_in), "rv": show(at(right), r_in), "least": show(least, both)})


def block_sums(b: pd.DataFrame) -> pd.DataFrame:
    """A block's classes with the sums over those before them in the block, and the least ids up to and from them."""
    b = b.sort_values("j")
    mins = b["least"].to_numpy()
    out = {c: np.cumsum(b[c].to_numpy(dtype=np.int64)) - b[c].to_numpy(dtype=np.int64) for c in SUMS}
    pre = np.minimum.accumulate(mins)
    return pd.DataFrame({"block": b["block"].to_numpy(), "j": b["j"].to_numpy(), **out, "pre": pre, "suf": np.minimum.accumulate(mins[::-1])[::-1]})


def bound(places: DataFrame, minima: list[int], m: int) -> DataFrame:
    """places whose l and r are all known: what a block left open is looked up in the block that the minima name.

    A block has as many open values as its longest chain of records, which no conversation's length exceeds.
    """
    back = np.array(minima)
    lasts, nexts = {}, {}

    def left_block(block: int, v: int) -> int:
        return lasts.setdefault((block, v), int(np.flatnonzero(back[:block] < v)[-1]) if block else -1)

    def right_block(block: int, v: int) -> int:
        found = np.flatnonzero(back[block + 1 :] < v)
        return nexts.setdefault((block, v), int(found[0]) + block + 1 if len(found) else -1)

    def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            pairs = list(zip(b["block"].tolist(), b["v"].tolist(), strict=True))
            yield b.assign(lb=[left_block(*p) if p[1] >= 0 else -1 for p in pairs], rb=[right_block(*p) for p in pairs])

    # Records: a block's places that are smaller than all before (after) them; those are what others look for.
    inside = lambda s: F.struct(*s)
    firsts = places.where("l is null").groupBy("block", "v").agg(F.min("pos").alias("pos")).groupBy("block").agg(F.collect_list(inside(["pos", "v"])).alias("firsts"))
    ends = places.where("r is null").groupBy("block", "v").agg(F.max("pos").alias("pos")).groupBy("block").agg(F.collect_list(inside(["pos", "v"])).alias("ends"))
    open_values = places.where("l is null or r is null").select("block", "v").distinct()
    asks = open_values.mapInPandas(asked, "block long, v int, lb long, rb long")
    smaller = lambda c: F.filter(c, lambda x: x["v"] < F.col("v"))
    found = asks.join(ends.withColumnRenamed("block", "lb"), "lb", "left").join(firsts.withColumnRenamed("block", "rb"), "rb", "left")
    found = found.select("block", "v", F.array_max(smaller("ends")).alias("_l"), F.array_min(smaller("firsts")).alias("_r"))
    out = places.join(found, ["block", "v"], "left")
    return out.select(
        "block", "pos", "v", F.coalesce("l", "_l.pos").alias("l"), F.coalesce("lv", "_l.v").alias("lv"),
        F.coalesce("r", "_r.pos", F.lit(2 * m)).alias("r"), F.coalesce("rv", "_r.v", F.lit(-1)).alias("rv"), "least",
    ).where("v >= 0")


def trie(convs: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations (c, ks, bs): see op12's columns.

    A conversation without turns is a member of the root; no conversation, no root. A conversation's
    digests (16 bytes a turn) stand in one row, so a task has to have room for the longest one.
    """
    members = written(small_batches(convs).select("c", "ks", "bs", digest(F.array_join(F.transform("ks", F.hex), "")).alias("cls")), "members")
    same = members.groupBy("cls").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least"), F.any_value(F.struct("ks", "bs")).alias("x"))
    classes, m = line(same.select("cls", "n", "least", "x.*"))
    ends = id_digests(members)
    width = max(CLASSES, -(-m // BLOCKS))
    sofar = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, b: a + b)
    size = F.size("ks")
    per = classes.select(
        F.floor(F.col("j") / width).alias("block"), "j", "n", "least", "lcp", size.alias("size"), (F.col("n") * sofar("bs")).alias("nb"),
        sofar(F.slice("bs", F.greatest("lcp", F.lit(0)) + 1, F.greatest(size, F.lit(1)))).alias("nu"), F.col("up").cast("long").alias("up"),
    )
    per = written(per, "blocks")
    places = written(per.groupBy("block").applyInPandas(block_places, PLACES), "places")
    spine = written(per.groupBy("block").applyInPandas(block_sums, SPINE), "spine")
    # A row for each block, BLOCKS at most.
    whole = per.groupBy("block").agg(F.min("lcp").alias("v"), F.min("least").alias("least"), *[F.sum(c).alias(c) for c in SUMS]).orderBy("block").collect()
    mins = F.array(*[F.lit(x["least"]) for x in whole])
    offsets = {c: np.concatenate([[0], np.cumsum([x[c] for x in whole])]).tolist() for c in SUMS}
    offset = lambda c: F.get(F.array(*[F.lit(x) for x in offsets[c][:-1]] or [F.lit(0)]), F.col("block").cast("int"))
    spine = spine.select("block", "j", "pre", "suf", *[(F.col(c) + offset(c)).alias(c) for c in SUMS])
    known = bound(places, [x["v"] for x in whole], m)

    # Places of equal value and left bound are one node; a class that ends there is at its left end.
    odd = F.col("pos") % 2 == 1
    nodes = known.groupBy("l", "v").agg(
        F.any_value("lv").alias("lv"), F.any_value("r").alias("r"), F.any_value("rv").alias("rv"), F.min("least").alias("least"),
        F.sum(F.when(odd, 0).otherwise(1)).alias("forks"), F.max(odd).alias("ended"),
    )
    nodes = nodes.select("*", (F.col("l") / 2).cast("long").alias("lj"), (F.col("r") / 2).cast("long").alias("rj"))
    left = spine.select(F.col("j").alias("lj"), F.col("block").alias("lb"), "suf", *[F.col(c).alias(f"l_{c}") for c in SUMS])
    right = spine.select((F.col("j") + 1).alias("rj"), F.col("block").alias("rb"), "pre")
    after = spine.select(F.col("j").alias("rj"), *[F.col(c).alias(f"r_{c}") for c in SUMS])
    nodes = nodes.join(left, "lj").join(right, "rj").join(after, "rj", "left")
    for c in SUMS:
        nodes = nodes.withColumn(f"r_{c}", F.coalesce(f"r_{c}", F.lit(offsets[c][-1])))
    between = F.array_min(F.slice(mins, (F.col("lb") + 2).cast("int"), F.greatest(F.col("rb") - F.col("lb") - 1, F.lit(0)).cast("int")))
    # Open nodes reach over a block's end, or to the end of the last one.
    nodes = nodes.withColumn("least", F.coalesce("least", F.when(F.col("lb") < F.col("rb"), F.least("suf", "pre", between)).otherwise(F.col("suf"))))
    nodes = written(nodes, "nodes")

    # A node's parent is the node of the larger one of its bounds' values; many may have one parent.
    outer = F.when(F.col("lv") >= F.col("rv"), F.col("l")).otherwise(F.col("r"))
    keys = known.where("pos % 2 = 0").select(F.col("pos").alias("outer"), F.col("l").alias("pl"), F.col("v").alias("pv"))
    forks = F.col("forks") + 1 - F.col("ended").cast("long")
    parents = nodes.where(forks > 0).select(F.col("l").alias("pl"), F.col("v").alias("pv"), F.col("least").alias("parent"), forks.alias("n"))
    tree = nodes.withColumn("forks", forks).withColumn("outer", outer).withColumn("pd", F.greatest("lv", "rv")).join(keys, "outer", "left")
    tree = dealt(tree, parents, ["pl", "pv"], "left")
    texts = classes.select(F.col("j").alias("lj"), "cls", "bs", "lcp", F.col("up").cast("long").alias("up")).join(ends, "cls", "left")
    head = lambda upto: sofar(F.slice("bs", F.lit(1), F.greatest(upto, F.lit(0))))
    from_ = F.greatest("pd", F.lit(0))
    ready = tree.join(texts, "lj").select(
        "least", "parent", "pd", "v", (F.col("r_n") - F.col("l_n")).alias("n"), "forks", "ended", "ends",
        # Classes, less those that are a prefix of the next one.
        (F.col("rj") - F.col("lj") - (F.col("r_up") - F.col("l_up") - F.col("up"))).alias("leaves"),
        (F.col("r_nb") - F.col("l_nb")).alias("bytes"),
        # Of the first class all bytes count, of the others those that the class before hasn't.
        (F.col("r_nu") - F.col("l_nu") + head(F.col("lcp"))).alias("fresh"),
        head(F.col("pd")).alias("base"), F.slice("bs", from_ + 1, F.col("v") - from_).alias("path"),
    )
    return small_batches(ready).mapInPandas(depths, NODES)


NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
#: Fixed value: the hash of no ids.
NO_ENDS = hashlib.sha256().hexdigest()


def depths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each node as one trie node for each depth behind its parent's."""
    for b in batches:
        out = []
        for x in b.itertuples(index=False):
            # Bytes of a member's turns before the one at each depth.
            before = x.base + np.concatenate([[0], np.cumsum(x.path, dtype=np.int64)])[:-1]
            before = np.concatenate([[0], before]).astype(np.int64) if x.pd < 0 else before.astype(np.int64)
            k = len(before)
            depth = np.arange(x.v - k + 1, x.v + 1)
            parent = [x.least] * k
            parent[0] = None if x.pd < 0 else x.parent
            saved = x.bytes - x.fresh - (x.n - 1) * before
            children, ends = [1] * k, [NO_ENDS] * k
            children[-1] = x.forks
            if x.ended:
                ends[-1] = x.ends
            out.append(pd.DataFrame({"conv_id": x.least, "depth": depth, "parent_conv_id": pd.array(parent, dtype="Int64"), "n_convs": x.n, "n_children": children, "n_leaves": x.leaves, "saved_tokens": saved, "ends_sha256": ends}))
        if out:
            yield pd.concat(out)


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations of turns (conv_id, turn, role, text).

    Null roles and texts are empty ones, null turns come first, and turns of one number stand in the
    order of their digests; a repeated row is one more turn. Rows without a conv_id belong to no
    conversation. An empty table gives no row; other columns are not read.
    """
    return trie(rebuilt(written(conversations(turns), "conversations")))


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))
