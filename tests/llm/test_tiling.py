"""Greedy string tiling against brute force, on all kinds of rows."""

import random
import re

import numpy as np

from plumbline.llm import tiling as T


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def greedy(x, y, least):
    """Tiles by looking at every pair of places again for each tile: the longest one, then the first in the document, then in the item."""
    used_x, used_y, out = set(), set(), []
    while True:
        best = (0, 0, 0)
        for i in range(len(x)):
            for j in range(len(y)):
                n = 0
                while i + n < len(x) and j + n < len(y) and x[i + n] == y[j + n] and i + n not in used_x and j + n not in used_y:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < least:
            return out
        out.append(best[0])
        used_x |= set(range(best[1], best[1] + best[0]))
        used_y |= set(range(best[2], best[2] + best[0]))


def expected(docs, items):
    out = []
    for k, t in docs:
        for i, u in items:
            x, y = words_of(t), words_of(u)
            if not y or (len(y) < T.SEED and x != y):
                continue
            found = greedy(x, y, min(T.SEED, len(y)))
            if sum(found) >= T.COVERAGE * len(y):
                out.append((k, i, len(found), round(sum(found) / len(y), 9)))
    return sorted(out, key=repr)


def found(spark, docs, items):
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    return sorted(((r["doc_id"], r["item_id"], r["n_tiles"], round(r["coverage"], 9)) for r in T.contamination(d, b).collect()), key=repr)


def test_against_brute_force(spark):
    r = random.Random(9)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice([2, 4, 5, 8, 14, 25])))) for i in range(25)]
    items += [(0, items[0][1]), (None, "a null item of some six words"), (90, None), (91, ""), (92, " .,; ")]
    docs = []
    for k in range(60):
        words = [r.choice(vocabulary) for _ in range(r.randint(0, 40))]
        for _ in range(r.choice([0, 1, 1, 2])):
            own = words_of(r.choice(items)[1])
            cut = r.randint(0, len(own))
            own = r.choice([own, own[cut:] + own[:cut], own[:cut], [*own[:cut], "zz", *own[cut:]]])
            at = r.randint(0, len(words))
            words[at:at] = own
        docs.append((k, r.choice([" ", ", ", "\n"]).join(words).upper()))
    docs += [(3, docs[4][1]), (None, items[5][1]), (None, "clean and null"), (70, None), (71, ""), (72, items[0][1]), (73, "A null item of some six words, twice: a NULL item of some six words")]
    want = expected(docs, items)
    assert len(want) > 20 and found(spark, docs, items) == want


def test_repeated_words_and_hot_seeds(spark):
    docs = [(k, "one two three four five six seven " * (1 + k % 3)) for k in range(80)] + [(200, "same " * 300)]
    items = [(1, "one two three four five six seven"), (2, "same " * 12), (3, "one two three four five " + " ".join(f"x{i}" for i in range(20)))]
    assert found(spark, docs, items) == expected(docs, items)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "some words of an item here")]) == found(spark, [(1, "some words of an item here")], []) == []


def test_clashing_columns(spark):
    d = spark.createDataFrame([(1, "some words of an item here")], "doc_id long, text string").selectExpr("*", "1 as k", "2 as i", "'x' as t", "3 as n", "4 as item_id")
    b = spark.createDataFrame([(7, "some words of an item here")], "item_id long, text string").selectExpr("*", "1 as k", "2 as i", "'x' as u")
    assert [(r["doc_id"], r["item_id"], r["coverage"]) for r in T.contamination(d, b).collect()] == [(1, 7, 1.0)]


def test_tiles_of_random_texts():
    r = random.Random(4)
    for _ in range(400):
        x, y = ([r.randrange(r.choice([1, 2, 3, 6])) for _ in range(r.randrange(0, 40))] for _ in "xy")
        least = r.choice([1, 2, 5])
        assert [t[0] for t in T.tiles(np.array(x, dtype=np.int64), np.array(y, dtype=np.int64), least)] == greedy(x, y, least)


def test_a_million_equal_words(spark):
    docs = [(1, "same " * 1_000_000), (2, "same other " * 300_000), (3, "same " * 5_000)]
    items = [(1, "same " * 10_000), (2, "same " * 300), (3, "other same " * 2_000 + "same " * 2_000)]
    assert found(spark, docs, items) == [(1, 1, 1, 1.0), (1, 2, 1, 1.0), (2, 3, 1, round(4000 / 6000, 9)), (3, 2, 1, 1.0)]
