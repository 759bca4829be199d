"""Best-fit packing of token pieces into sequences by a configuration linear program.

The lengths of all pieces form a histogram of at most `capacity` bars, so the program does not grow
with the corpus. Its columns are configurations: multisets of lengths that fit one sequence.
Multiplicative weights solve its covering form: each length is worth its tokens times a weight that
falls with the share of it that is covered, a knapsack dynamic program over exact lengths finds the
configurations of highest price (one for each length, from one table), and each is rounded down to
whole sequences at once, so that the next round prices what is left. Best fit decreasing packs the
last few hundredths, to which the shortest lengths are kept. The plan (configurations with
multiplicities) is a bounded table; pieces find their sequences by their rank among the pieces of
their length, without being sorted or collected.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import body, small_batches, written
from plumbline.llm.word_bpe import WordEncoder

#: Characters of text that a worker encodes at once.
SLICE = 1 << 20
#: Rounds of the multiplicative weights, how strongly a covered length gets cheaper, and the share of a length
#: that one configuration takes in a round at most.
ROUNDS, STEP, SHARE = 100, 0.1, 0.25
#: Share of all tokens at which best fit takes over, and share of the shortest lengths that is kept for it.
REST, SHORTEST = 0.06, 0.004


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int) -> WordEncoder:
    return WordEncoder(path, end_id)


def best_values(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """By room from 0 to capacity: the highest total price of sizes (ascending) that fit, and the size to take first (-1: a free token)."""
    value, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        value[room] = value[room - 1]
        if n := fitting[room]:
            worth = value[room - sizes[:n]] + prices[:n]
            best = int(worth.argmax())
            if worth[best] > value[room]:
                value[room], choice[room] = worth[best], best
    return value, choice


def configuration(first: int, left: np.ndarray, sizes: np.ndarray, prices: np.ndarray, value: np.ndarray, choice: np.ndarray) -> tuple[dict[int, int], int]:
    """The best configuration with `first` in it that the stock allows (by index), and the tokens that it leaves free.

    Where the table's choice is used up, the best one of those in stock stands in.
    """
    use, room = {first: 1}, len(value) - 1 - int(sizes[first])
    while room > 0:
        k = int(choice[room])
        if k >= 0 and use.get(k, 0) >= left[k]:
            n = int(np.searchsorted(sizes, room, side="right"))
            worth = np.where(left[:n] > 0, value[room - sizes[:n]] + prices[:n], -1.0)
            for i, x in use.items():
                if i < n and x >= left[i]:
                    worth[i] = -1.0
            k = int(worth.argmax())
            if worth[k] < 0:
                break
        if k < 0:
            free = np.flatnonzero(choice[:room] >= 0)
            if not len(free):
                break
            room = int(free[-1])
            continue
        use[k] = use.get(k, 0) + 1
        room -= int(sizes[k])
    return use, len(value) - 1 - sum(int(sizes[k]) * n for k, n in use.items())


def priced(stock: Counter, capacity: int, rounds: int) -> Counter:
    """Sequences by configurations of the program; takes their pieces out of the stock.

    A configuration may leave no token free, as long as a round finds any such; else what it may leave is
    raised until one is found.
    """
    plan: Counter = Counter()
    lengths = np.array(sorted(stock), dtype=np.int64)
    need = np.array([stock[int(x)] for x in lengths], dtype=np.int64)
    left, total = need.copy(), int((lengths * need).sum())
    kept = np.cumsum(lengths * need) <= SHORTEST * total
    slack = 0
    for _ in range(rounds):
        live = np.flatnonzero((left > 0) & ~kept)
        if not len(live) or (left * lengths).sum() <= REST * total:
            break
        sizes, own, most = lengths[live], left[live], np.maximum(1, (SHARE * need[live]).astype(np.int64))
        prices = sizes * np.exp(-STEP * (1 - own / need[live]))
        value, choice = best_values(sizes, prices, capacity)
        found = 0
        for first in np.argsort(-(prices + value[capacity - sizes]), kind="stable").tolist():
            if own[first] <= 0:
                continue
            use, free = configuration(first, own, sizes, prices, value, choice)
            if free > slack:
                continue
            runs = max(1, min(int(min(own[k], most[k])) // n for k, n in use.items()))
            plan[tuple(sorted((int(sizes[k]) for k, n in use.items() for _ in range(n)), reverse=True))] += runs
            found += runs
            for k, n in use.items():
                own[k] -= n * runs
        left[live] = own
        if not found:
            if slack >= capacity:
                break
            slack = min(capacity, max(1, 4 * slack))
    for x, n in zip(lengths.tolist(), left.tolist(), strict=True):
        stock[x] = n
    return plan


def fill(keys: list[int], stock: Counter, use: Counter, room: int) -> None:
    """Adds to `use`, again and again, the longest length in stock that still fits."""
    k = len(keys)
    while k and room >= keys[0]:
        k = bisect_left(keys, room + 1, hi=k)
        if not k:
            break
        length = keys[k - 1]
        n = min(room // length, stock[length] - use[length])
        if n > 0:
            use[length] += n
            room -= length * n
        k -= 1


def best_fit(stock: Counter, capacity: int) -> Counter:
    """Best fit decreasing, for all sequences of equal contents at once; empties the stock."""
    plan, lengths = Counter(), sorted(stock)
    while keys := [x for x in lengths if stock[x] > 0]:
        use: Counter = Counter()
        fill(keys, stock, use, capacity)
        runs = min(stock[x] // n for x, n in use.items())
        plan[tuple(sorted(use.elements(), reverse=True))] += runs
        for x, n in use.items():
            stock[x] -= n * runs
    return plan


def solve(histogram: dict[int, int], capacity: int, rounds: int = ROUNDS) -> list[tuple[tuple[int, ...], int]]:
    """A packing plan: (lengths of a configuration, how many sequences use it).

    Every length of the histogram is covered exactly; lengths of `capacity` fill a sequence alone. Should
    best fit alone need fewer sequences (a few pieces, in which nothing can be rounded), its plan is taken.
    """
    stock = Counter({int(k): int(v) for k, v in histogram.items() if v > 0})
    full = stock.pop(capacity, 0)
    plain = best_fit(stock.copy(), capacity)
    plan = priced(stock, capacity, rounds)
    plan += best_fit(stock, capacity)
    if sum(plain.values()) < sum(plan.values()):
        plan = plain
    if full:
        plan[(capacity,)] += full
    return sorted(plan.items(), reverse=True)


def seats(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """The plan by length: ranks from `low` to `high` - 1 of a length go to sequences from `sequence` on, at `offset`."""
    rows, used, sequence = [], Counter(), 0
    for config, runs in plan:
        offset = 0
        for length in config:
            rows.append((length, used[length], used[length] + runs, sequence, offset))
            used[length] += runs
            offset += length
        sequence += runs
    return rows


def pack(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and the end id; a longer one than capacity is cut into pieces of capacity
    ids, the last one may be shorter. Null and empty texts are one piece, the end id alone. Repeated
    rows and ids are packed each for itself; an empty table gives an empty result. vocabulary: path
    of the tokenizer's file, at the same place on all executors.
    """
    spark = docs.sparkSession
    docs = small_batches(docs).select(F.col(id_col).alias("doc_id"), body(text_col).alias("t"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, width = encoder(vocabulary, end_id).encode, 4 * capacity
        part, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            out = []
            slices = (batch["t"].map(len).cumsum() // SLICE).to_numpy()
            coded = (x for _, texts in batch["t"].groupby(slices, sort=False) for x in encode(texts.tolist()))
            for doc, ids in zip(batch["doc_id"], coded, strict=True):
                for k, at in enumerate(range(0, len(ids), width)):
                    own = ids[at : at + width]
                    n = len(own) // 4
                    out.append((doc, k, at // 4, n, zlib.crc32(own), part, seen[n]))
                    seen[n] += 1
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    made = written(docs.mapInPandas(pieces, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, nth long"), "pieces")
    # Each task has numbered its pieces by length; what earlier tasks have of a length comes before.
    counts = made.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "part", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("skip"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    # Bounded: the plan has rows by configuration and length, not by piece.
    table = spark.createDataFrame(seats(solve(histogram, capacity)), "length long, low long, high long, sequence long, offset long")
    ranked = made.join(counts.select("length", "part", "skip"), ["length", "part"]).withColumn("rank", F.col("nth") + F.col("skip"))
    place = (F.col("p.length") == F.col("r.length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    return (
        ranked.alias("r")
        .join(F.broadcast(table).alias("p"), place)
        .select("r.doc_id", "r.piece", "r.start", "r.length", "r.ids_crc32", (F.col("p.sequence") + F.col("r.rank") - F.col("p.low")).alias("sequence_id"), "p.offset")
    )


def op5_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from plumbline.llm.common import table

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
