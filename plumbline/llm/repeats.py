"""Exact removal of repeated byte strings: bucket-pointer refinement of sampled suffixes.

A byte goes if a string of `length` bytes that covers it also starts earlier (in a document of
smaller id, or earlier in its own). Suffixes are sorted into buckets only as deep as `length`, as
deeper order decides nothing here.

    anchors  One suffix is sampled for each neighbourhood: every string's anchor is the gram in it with
             the least fingerprint, so equal strings meet at equal distances from equal anchors. An
             anchor gram that stands once closes its strings; strings whose whole neighbourhood stands
             earlier (128-bit digests) are repeats as they are. What is left is open: neighbourhoods
             that share an anchor and differ somewhere.
    q-grams  Open neighbourhoods are cut at every q-th byte from their anchor. The suffix at each cut gets
             its initial bucket by its first q bytes; a bucket's identifier is a pointer to its first member.
    refining Suffixes are sorted by the pair of their own bucket and the bucket q bytes on, which gives
             buckets of 2q bytes, whose pointers replace the old ones; a bucket of one member is closed.
             q neighbouring starts share the bytes from the next cut on: they are sorted by its bucket
             (2q bytes) and by the bucket 2q bytes behind it, 3q bytes in all.
    edges    In such a bucket starts are told apart by the bytes themselves: those before the first cut
             and behind the last one; whole blocks first, then start by start where blocks differ.

In each step the first member of a class stands for it, and only first members go on, so the work of
a step serves all that repeats it. From the q-grams on everything rests on bytes and pointers, not on
fingerprints. Hot buckets are dealt out in parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import body, dealt, done, numbered, written
from plumbline.llm.grams import Spans, anchors

#: Bytes of an anchor's gram; q, the bytes between two cuts, a multiple of 8; cuts of a neighbourhood at most;
#: bytes that a task fingerprints at once.
GRAM, CELL, CUTS, SLICE = 32, 24, 16, 1 << 18


def packed(first: np.ndarray, last: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A run of string starts as one number: its first start, how many more follow, how far its anchor is."""
    return (first << 16) | ((last - first) << 8) | (at - first)


def unpacked(run: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    first = run >> 16
    return first, first + ((run >> 8) & 255), first + (run & 255)


def slices(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of about SLICE bytes of text: them, their bytes, and where each text starts and ends."""
    for batch in batches:
        sizes = batch["t"].map(len).to_numpy(dtype=np.int64)
        group = (np.cumsum(sizes) - sizes) // SLICE
        for _, rows in batch.groupby(group, sort=False):
            data = np.frombuffer(b"".join(rows["t"]), dtype=np.uint8)
            ends = np.cumsum(rows["t"].map(len).to_numpy(dtype=np.int64))
            yield rows, data, np.concatenate([[0], ends[:-1]]), ends


def level0(length: int, whole: bool):
    """Anchors of all texts: their gram's fingerprint, and if `whole` also digests of what they answer for and the run."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for own, data, starts, ends in slices(batches):
            a = anchors(data, starts, ends, length, GRAM)
            bucket = a.print.view(np.int64)
            if not whole:
                yield pd.DataFrame({"bucket": bucket})
                continue
            text = np.searchsorted(starts, a.at, side="right") - 1
            d1, d2 = Spans(data).prints(a.first, a.last + length, a.at - a.first)
            at = starts[text]
            yield pd.DataFrame({"bucket": bucket, "d1": d1, "d2": d2, "k": own["k"].to_numpy()[text], "run": packed(a.first - at, a.last - at, a.at - at)})

    return rows


def cuts_of(runs: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """First and last starts of runs, their anchors, and their first cuts (at or before the first starts)."""
    first, last, at = unpacked(runs)
    return first, last, at, at - CELL * (-(-(at - first) // CELL))


GRAMS = [f"g{k}" for k in range(CELL // 8)]


def grams_of(length: int):
    """The q-grams at the cuts of open runs: the run's number r and the cut's i, and the bytes as whole numbers."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, numbers, runs in zip(batch["t"], batch["rs"], batch["runs"], strict=True):
                data = np.frombuffer(text, dtype=np.uint8)
                first, last, _, low = cuts_of(np.asarray(runs, dtype=np.int64), length)
                i = np.tile(np.arange(CUTS), len(first))
                of = np.repeat(np.arange(len(first)), CUTS)
                at = low[of] + CELL * i
                # No string of a run reaches beyond last + length, and none starts before first.
                some = (at >= first[of]) & (at + CELL <= last[of] + length)
                i, of, at = i[some], of[some], at[some]
                out.append((np.asarray(numbers, dtype=np.int64)[of], i, np.ascontiguousarray(data[at[:, None] + np.arange(CELL)]).view("<i8")))
            if out:
                r, i, grams = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pd.DataFrame({"r": r, "i": i, **{g: grams[:, k] for k, g in enumerate(GRAMS)}})

    return rows


def pointed(rows: DataFrame, keys: list[str], out: str) -> DataFrame:
    """(r, i, out): a pointer (not 0) to the first member of each row's bucket; members of buckets of one are dropped."""
    first = F.min(F.col("r") * CUTS + F.col("i") + 1)
    buckets = written(rows.groupBy(*keys).agg(first.alias(out), F.count(F.lit(1)).alias("n")).where("n > 1"), "repeat-pointers")
    found = written(dealt(rows, buckets, keys).select("r", "i", out), "repeat-pointed")
    done(buckets)
    return found


def refined_pointers(texts: DataFrame, left: DataFrame, length: int) -> tuple[DataFrame, tuple[DataFrame, DataFrame]]:
    """By open run (r) the pointers of its n buckets, id of those of 2q bytes at i = cut and of q bytes at i = CUTS + cut; and the tables read for it."""
    grams = open_texts(texts, left).mapInPandas(grams_of(length), "r long, i int, " + ", ".join(f"{g} long" for g in GRAMS))
    shorts = pointed(grams, GRAMS, "short")
    later = shorts.select("r", (F.col("i") - 1).alias("i"), F.col("short").alias("later"))
    longs = pointed(shorts.join(later, ["r", "i"]), ["short", "later"], "long")
    every = longs.select("r", "i", F.col("long").alias("id")).unionByName(shorts.select("r", (F.col("i") + CUTS).alias("i"), F.col("short").alias("id")))
    by = every.groupBy("r").agg(F.collect_list(F.struct("i", "id")).alias("x")).select("r", F.size("x").alias("n"), F.col("x.i").alias("i"), F.col("x.id").alias("id"))
    return by, (shorts, longs)


def blocks_of(length: int):
    """Blocks of q neighbouring starts of open runs: bucket (x, y), where they start, and the bytes at their edges.

    A block from cut i on shares the bytes of the cells i + 1 to i + 3; `low` and `high` are its first
    and last start, from its own cut; `head` the bytes from its first start to cell i + 1, `tail` those
    behind cell i + 3 up to the end of its last string.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, heads, tails = [], [], []
            for k, text, runs, ns, places, own in zip(*(batch[c] for c in ("k", "t", "runs", "ns", "places", "ids")), strict=True):
                ids = np.zeros((len(runs), 2 * CUTS), dtype=np.int64)
                ids[np.repeat(np.arange(len(runs)), np.asarray(ns)), np.asarray(places)] = own
                first, last, at, cut = cuts_of(np.asarray(runs, dtype=np.int64), length)
                i = np.tile(np.arange(CUTS - 3), len(first))
                of = np.repeat(np.arange(len(first)), CUTS - 3)
                p = cut[of] + CELL * i
                x, y = ids[of, i + 1], ids[of, CUTS + i + 3]
                some = (p <= last[of]) & (x > 0) & (y > 0)
                of, p, x, y = of[some], p[some], x[some], y[some]
                a, b = np.maximum(p, first[of]), np.minimum(p + CELL - 1, last[of])
                out.append((x, y, a - p, b - p, np.full(len(x), k), packed(a, b, at[of])))
                for s, e, q in zip(a.tolist(), b.tolist(), p.tolist(), strict=True):
                    heads.append(text[s : q + CELL])
                    tails.append(text[q + 4 * CELL : e + length])
            if out:
                x, y, low, high, k, run = (np.concatenate(c) for c in zip(*out, strict=True))
                yield pd.DataFrame({"x": x, "y": y, "low": low, "high": high, "head": heads, "tail": tails, "k": k, "run": run})

    return rows


BLOCKS = "x long, y long, low int, high int, head binary, tail binary, k long, run long"


def firsts_of(members: DataFrame, bucket: list[str], kind: list[str], level: int, last: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """The members' and their classes' first members' numbers (k, x; see covered()), and all columns of those first members whose bucket has more classes.

    Both are written; members and what leads there is emptied.
    """
    classes = written(members.groupBy(*bucket, *kind).agg(F.min(F.struct("k", "run")).alias("first")).select(*bucket, *kind, "first.k", "first.run"), "repeat-classes")
    number = lambda rows, first: rows.select("k", (F.col("run") * 8 + (2 * level + first)).alias("x"))
    # Runs that are their class's first members are there twice, and no repeats; see covered().
    numbers = written(number(members, 0).unionByName(number(classes, 1)), "repeat-numbers")
    left = None
    if not last:
        several = written(classes.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeat-several")
        left = written(dealt(classes, several, bucket).withColumn("r", F.monotonically_increasing_id()), "repeat-left")
        done(several)
    done(members, classes)
    return numbers, left


def open_texts(texts: DataFrame, runs: DataFrame) -> DataFrame:
    by = runs.groupBy("k").agg(F.collect_list(F.struct("r", "run")).alias("x"))
    return texts.join(by.select("k", F.col("x.r").alias("rs"), F.col("x.run").alias("runs")), "k")


def repeated_runs(texts: DataFrame, length: int) -> DataFrame:
    """By text (k), the numbers xs of its runs and first members in all steps; see covered()."""
    prints = texts.select("t").mapInPandas(level0(length, False), "bucket long")
    shared = written(prints.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeat-buckets")
    members = written(dealt(texts.mapInPandas(level0(length, True), "bucket long, d1 long, d2 long, k long, run long"), shared, ["bucket"]), "repeat-anchors")
    done(shared)
    runs, left = firsts_of(members, ["bucket"], ["d1", "d2"], 0)

    ids, read = refined_pointers(texts, left.select("k", "run", "r"), length)
    pointers = left.select("k", "run", "r").join(ids, "r").groupBy("k").agg(F.collect_list(F.struct("run", "n", "i", "id")).alias("x"))
    pointers = pointers.select("k", F.col("x.run").alias("runs"), F.col("x.n").alias("ns"), F.flatten("x.i").alias("places"), F.flatten("x.id").alias("ids"))
    blocks = written(texts.join(pointers, "k").mapInPandas(blocks_of(length), BLOCKS), "repeat-blocks")
    done(left, *read)
    found, left = firsts_of(blocks, ["x", "y"], ["low", "high", "head", "tail"], 1)
    runs = runs.unionByName(found)

    # Start by start: `off` from the cut, and the string's bytes at either edge.
    single = left.withColumn("off", F.explode(F.sequence("low", "high")))
    start = F.shiftright("run", 16) + F.col("off") - F.col("low")
    far = F.shiftright("run", 16) + F.col("run").bitwiseAND(255) - start
    edge = lambda c, at, n: F.substr(F.col(c), at.cast("int"), n.cast("int"))
    single = single.select("x", "y", "off", edge("head", F.col("off") - F.col("low") + 1, F.lit(CELL)).alias("head"), edge("tail", F.lit(1), F.col("off") + length - 4 * CELL).alias("tail"), "k", F.shiftleft(start, 16).bitwiseOR(far).alias("run"))
    found, _ = firsts_of(written(single, "repeat-starts"), ["x", "y", "off"], ["head", "tail"], 2, last=True)
    done(left)
    # In later steps the first members of the step before come again, cut in blocks: they are repeats
    # where a block is not a first member itself. So runs of different steps never mix.
    return runs.unionByName(found).groupBy("k").agg(F.collect_list("x").alias("xs"))


def covered(size: int, xs: np.ndarray | None, length: int) -> list[tuple[int, int]]:
    """Maximal runs [a, b) of bytes that repeats cover."""
    if xs is None or not len(xs):
        return []
    # A run that is there as a first member too is no repeat.
    runs, times = np.unique(np.asarray(xs, dtype=np.int64) >> 1, return_counts=True)
    runs = runs[times == 1] >> 2
    first = runs >> 16
    end = np.minimum(first + ((runs >> 8) & 255) + length, size)
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(end[order])
    if not len(first):
        return []
    new = np.concatenate([[True], first[1:] > reach[:-1]])
    return list(zip(first[new].tolist(), reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(first) - 1]])].tolist(), strict=True))


def without(text: bytes, cuts: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for a, b in cuts:
        parts.append(text[at:a])
        at = b
    return b"".join([*parts, text[at:]])


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """Repeated strings of `length` bytes taken out of the texts.

    digest: one row per row of docs with doc_id, n_bytes, n_removed, n_spans, kept_sha256. Else the
    rows of docs with all their columns, the text without what was removed (letters of which only
    some bytes went are dropped whole). Null texts count as empty (and stay null). Repeated rows, or rows of
    one id, are documents of their own, in the order of their texts; null ids come first. Extra
    columns may have any names. An empty table gives an empty result. `length` must be 4 * CELL or more,
    and an anchor's neighbourhood may have CUTS cuts at most.
    """
    if not 4 * CELL <= length or (2 * length - GRAM) // CELL + 2 > CUTS:
        raise ValueError(f"{length} bytes is too short or too long")
    base = numbered(docs.select(F.col(id_col).alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), body(text_col).cast("binary").alias("t")), "id", "t")
    runs = repeated_runs(base.select("k", "t"), length)
    joined = base.drop("row") if digest else base
    joined = joined.join(runs, "k", "left")
    kind = docs.schema[id_col].dataType.simpleString()

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text, xs in zip(batch["id"], batch["t"], batch["xs"], strict=True):
                cuts = covered(len(text), xs, length)
                out.append((doc, len(text), sum(b - a for a, b in cuts), len(cuts), hashlib.sha256(without(text, cuts)).hexdigest()))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["left"] = [without(t, covered(len(t), xs, length)).decode("utf-8", "ignore") for t, xs in zip(batch["t"], batch["xs"], strict=True)]
            yield batch[["k", "left"]]

    if digest:
        return joined.select("id", "t", "xs").mapInPandas(digests, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    changed = joined.where(F.col("xs").isNotNull()).select("k", "t", "xs").mapInPandas(texts, "k long, left string")
    whole = base.select("k", "row").join(changed, "k", "left")
    return whole.select(*[(F.coalesce("left", f"row.`{c}`") if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op7_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    from plumbline.llm.common import table

    return remove_repeats(table(spark, sf_dir, "documents"), digest=True)
