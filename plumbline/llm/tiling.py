"""Benchmark decontamination by greedy string tiling.

Seeds are runs of SEED words that a document shares with a benchmark item, found by rolling
fingerprints (Karp-Rabin). A pair's longest common run without marked words is marked again and
again, until no run of a seed's length is left; the length is found by bisection over the prints of
all runs, and all runs of it are marked in one sweep. The share of an item's words under tiles is its
coverage, however its passages are ordered in the document.

One plan serves a benchmark of any size. A bit table of fixed size, made of the items' seeds, goes to
all tasks and sorts out what can't be a common seed; what it lets through is joined. An item whose
coverage is to be reached shares a known number of its seeds, so its most frequent seeds, fewer than
that, are not needed to find the documents that may hold it; hot seeds and hot items are dealt out in
parts. Such pairs first meet by all their seeds, as places in the item without texts (a repeated seed
once for the document, so that nothing grows with the product of places); pairs whose seeds cover
enough of the item are then tiled word by word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import body, dealt, numbered, small_batches, written
from plumbline.llm.grams import mixed, words_of
from plumbline.llm.repeats import slices

#: Words of a seed, which is the shortest tile; coverage from which a document counts as contaminated.
SEED, COVERAGE = 5, 0.6
#: Bits of the table that sorts out seeds, as a power of two (8 MB, whatever the benchmark's size).
BITS = 26
#: Bytes between words (ASCII other than letters and digits).
BETWEEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def seeds_of(w: np.ndarray, text: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Prints of the runs of SEED words that lie in one text, and where they start; a shorter text with words is one run."""
    at = np.flatnonzero(text[: len(text) - SEED + 1] == text[SEED - 1 :]) if len(text) >= SEED else np.zeros(0, dtype=np.int64)
    out = np.zeros(len(at), dtype=np.uint64)
    for k in range(SEED):
        out = out * np.uint64(0x9E3779B97F4A7C15) + w[at + k]
    count = np.bincount(text, minlength=n_texts) if len(text) else np.zeros(n_texts, dtype=np.int64)
    short = np.flatnonzero((count > 0) & (count < SEED))
    first = np.searchsorted(text, short)
    some = count[short].astype(np.uint64)
    for k in range(SEED - 1):
        has = count[short] > k
        some[has] = some[has] * np.uint64(0xC2B2AE3D27D4EB4F) + w[first[has] + k]
    return np.concatenate([mixed(out), mixed(some)]), np.concatenate([at, first])


def words_in(text: bytes) -> list[bytes]:
    """Words as they are compared in the end."""
    return [w.lower() for w in re.split(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text) if w]


class Runs:
    """Prints of all runs of a length in a text, given as numbers of its words, by differences of running sums."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, words: np.ndarray):
        n = len(words)
        factors = np.ones((2, n + 1), dtype=np.uint64)
        factors[0, 1:], factors[1, 1:] = self.BASE, pow(self.BASE, -1, 1 << 64)
        power, self.back = np.cumprod(factors, axis=1, dtype=np.uint64)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(mixed(words.astype(np.uint64) + np.uint64(1)) * power[:n], dtype=np.uint64, out=self.sums[1:])
        self.marked = np.zeros(n, dtype=bool)

    def free(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and prints of the runs of a size that hold no marked word.

        Marks are at least as long as that, so one in a run covers one of its ends.
        """
        n = len(self.marked) - size + 1
        at = np.flatnonzero(~self.marked[:n] & ~self.marked[size - 1 :])
        return at, (self.sums[at + size] - self.sums[at]) * self.back[at]


def tiles(x: np.ndarray, y: np.ndarray, seed: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy tiles (length, start in x, start in y) of two texts, given as numbers of their words.

    The longest common run without marked words is looked for by bisection over its length, with
    prints of all runs of a length (Karp-Rabin). All runs of that length are marked in one sweep, the
    first in x first, then the first in y; then the next shorter length is looked for. So the work grows
    with the texts and the tiles' lengths, not with the number of places that match.
    """
    a, b, out, top = Runs(x), Runs(y), [], min(len(x), len(y))
    while top >= seed:
        low, high, best = seed, top, None
        while low <= high:
            size = (low + high + 1) // 2 if best else low
            (i, p), (j, q) = a.free(size), b.free(size)
            order = np.argsort(q, kind="stable")
            q = q[order]
            some = np.flatnonzero(q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p) if len(q) else []
            if len(some):
                best, low = (size, i[some], p[some], j[order], q), size + 1
            else:
                high = size - 1
        if best is None:
            break
        size, starts, prints, places, sorted_prints = best
        first, last, end = np.searchsorted(sorted_prints, prints), np.searchsorted(sorted_prints, prints, side="right"), 0
        at: dict[int, int] = {}
        live = len(np.unique(first))
        for s, lo, hi in zip(starts.tolist(), first.tolist(), last.tolist(), strict=True):
            k = at.get(lo, lo)
            if s < end or k == hi:
                continue
            while k < hi and (b.marked[places[k]] or b.marked[places[k] + size - 1]):
                k += 1
            if k < hi and (x[s : s + size] == y[places[k] : places[k] + size]).all():
                out.append((size, s, int(places[k])))
                end = s + size
                a.marked[s:end] = True
                b.marked[places[k] : places[k] + size] = True
                k += 1
            at[lo] = k
            live -= k == hi
            if not live:
                break
        top = size - 1
    return out


def seed_rows(name: str, bits: Broadcast | None = None):
    """Rows (name, n, at, seed) of the seeds of texts: n words in all, where the seed starts; with bits only seeds in them, and once each."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for own, data, starts, ends in slices(batches):
            words = words_of(data, starts, ends, BETWEEN)
            seeds, at = seeds_of(words.print, words.text, len(own))
            if bits is not None:
                where = seeds >> np.uint64(64 - BITS)
                some = (bits.value[(where >> np.uint64(6)).astype(np.int64)] >> (where & np.uint64(63))) & np.uint64(1) == 1
                seeds, at = seeds[some], at[some]
                order = np.lexsort((at, seeds, words.text[at]))
                seeds, at = seeds[order], at[order]
                new = np.concatenate([[True], (seeds[1:] != seeds[:-1]) | (words.text[at[1:]] != words.text[at[:-1]])])[: len(at)]
                seeds, at = seeds[new], at[new]
            text = words.text[at]
            count = np.bincount(words.text, minlength=len(own))
            first = np.concatenate([[0], np.cumsum(count)[:-1]]).astype(np.int64)
            yield pd.DataFrame({name: own[name].to_numpy()[text], "n": count[text], "at": at - first[text], "seed": seeds.view(np.int64)})

    return rows


def bit_table(seeds: DataFrame) -> np.ndarray:
    """2^BITS bits, of which each seed's is set: 2^(BITS - 6) numbers at most come to the driver."""
    where = F.shiftrightunsigned("seed", 64 - BITS)
    words = seeds.groupBy(F.shiftright(where, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(seed, {64 - BITS}) & 63 as int))")).alias("bits")).toPandas()
    out = np.zeros(1 << (BITS - 6), dtype=np.uint64)
    out[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return out


def tiled(coverage: float):
    """Of pairs of a document and an item: n_tiles and coverage, where that is enough."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, doc, item, text, other in zip(batch["k"], batch["doc_id"], batch["item_id"], batch["t"], batch["u"], strict=True):
                x, y = words_in(text), words_in(other)
                if len(y) < SEED:
                    found = [(len(y), 0, 0)] if x == y else []
                else:
                    number: dict[bytes, int] = {}
                    x, y = (np.array([number.setdefault(w, len(number)) for w in z], dtype=np.int64) for z in (x, y))
                    found = tiles(x, y)
                covered = sum(t[0] for t in found)
                if found and covered >= coverage * len(y):
                    out.append((k, doc, item, len(found), covered / len(y)))
            yield pd.DataFrame(out, columns=["k", "doc_id", "item_id", "n_tiles", "coverage"])

    return rows


def reach(places: Column) -> Column:
    """How many words the seeds at these places (an array without repeats) cover."""
    start = F.struct(F.lit(-SEED).cast("long").alias("at"), F.lit(0).cast("long").alias("sum"))
    step = lambda a, x: F.struct(x.alias("at"), (a["sum"] + F.least(x - a["at"], F.lit(SEED))).alias("sum"))
    return F.aggregate(F.array_sort(places), start, step, lambda a: a["sum"])


def contamination(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and benchmark item that it holds: k, doc_id, item_id, n_tiles, coverage. See held()."""
    return held(with_keys(docs, id_col, text_col), benchmark, coverage)


def with_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs as k (a unique key), doc_id, row (all columns) and t (the text's bytes)."""
    return numbered(docs.select(F.col(id_col).alias("doc_id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), body(text_col).cast("binary").alias("t")), "doc_id", "t")


def held(base: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Which rows of base (k, doc_id, t) hold which benchmark items (item_id, text): k, doc_id, item_id, n_tiles, coverage.

    Words are runs of ASCII letters and digits and of other characters, A-Z lower-cased. An item of
    fewer than SEED words is held by a document that has just these words and no others, as within
    a longer text so few say nothing. Null and empty texts and items hold and are nothing. Rows of one id
    are documents of their own, with different k; repeated items count once each. Empty tables give
    an empty result; extra columns are not looked at.
    """
    spark = base.sparkSession
    items = written(small_batches(benchmark).select("item_id", body("text").cast("binary").alias("u"), F.monotonically_increasing_id().alias("i")), "items")
    own = written(items.select("i", F.col("u").alias("t")).mapInPandas(seed_rows("i"), "i long, n long, at long, seed long"), "item-seeds")
    bits = spark.sparkContext.broadcast(bit_table(own))
    texts = base.select("k", "t").mapInPandas(seed_rows("k", bits), "k long, n long, at long, seed long")
    hits = written(texts, "document-seeds")

    # An item of n words that is covered shares at least `share` of its seeds: a tile of m words has
    # m - SEED + 1 >= m / SEED of them. So one of its rarest m - share + 1 is shared, too.
    common = hits.groupBy("seed").agg(F.count(F.lit(1)).alias("docs"))
    ranked = own.join(common, "seed").withColumn("_turn", F.row_number().over(Window.partitionBy("i").orderBy("docs", "seed", "at")))
    total = F.greatest(F.col("n") - (SEED - 1), F.lit(1))
    share = F.greatest(F.ceil(F.lit(coverage / SEED) * F.col("n")), F.lit(1))
    absent = own.groupBy("i").agg(F.count(F.lit(1)).alias("_all")).join(ranked.groupBy("i").agg(F.count(F.lit(1)).alias("_met")), "i").select("i", (F.col("_all") - F.col("_met")).alias("_absent"))
    keys = ranked.join(absent, "i").where(F.col("_turn") <= total - share + 1 - F.col("_absent")).select("seed", "i", F.col("docs").alias("n")).distinct()
    keys = written(keys, "item-keys")
    short = own.where(F.col("n") < SEED).select("i").distinct()
    pairs = dealt(hits.select("seed", "k", F.col("n").alias("words")), keys, ["seed"])
    pairs = pairs.join(short.withColumn("_short", F.lit(True)), "i", "left").where(F.col("_short").isNull() == (F.col("words") >= SEED)).select("k", "i").distinct()
    pairs = written(pairs, "seed-pairs")

    # Such pairs by all their seeds: what these cover of the item is the most that tiles can.
    per_item = pairs.groupBy("i").agg(F.count(F.lit(1)).alias("n"))
    spots = own.groupBy("i", "seed").agg(F.first("n").alias("size"), F.collect_list("at").alias("at"))
    spots = written(spots.join(per_item, "i"), "item-spots")
    shared = dealt(pairs, spots, ["i"], sizes=spots.select("i", "n").distinct()).join(hits.select("k", "seed"), ["k", "seed"])
    shared = shared.groupBy("k", "i").agg(F.first("size").alias("size"), F.flatten(F.collect_list("at")).alias("at"))
    enough = (F.col("size") < SEED) | (reach(F.col("at")) >= coverage * F.col("size"))
    found = written(shared.where(enough).select("k", "i"), "likely-pairs")
    wanted = written(items.join(found.groupBy("i").agg(F.count(F.lit(1)).alias("n")), "i"), "likely-items")
    rows = dealt(found.join(base.select("k", "doc_id", "t"), "k"), wanted, ["i"], sizes=wanted.select("i", "n")).select("k", "doc_id", "item_id", "t", "u")
    kind, item_kind = (d.schema[c].dataType.simpleString() for d, c in ((base, "doc_id"), (items, "item_id")))
    return rows.mapInPandas(tiled(coverage), f"k long, doc_id {kind}, item_id {item_kind}, n_tiles int, coverage double")


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    from plumbline.llm.common import table

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "item_id", "n_tiles", "coverage")
