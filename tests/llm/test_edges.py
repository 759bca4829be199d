"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for each operator."""

import hashlib
import random
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from plumbline.llm import cotraining, decision_rules, html_text, licenses, neardup, packing, repeats, shards, tiling, token_counts

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
LONG = " ".join(f"word{i % 977} and the {i}" for i in range(6000))
ROWS = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "The quick brown fox jumps over the lazy dog. " * 5), (6, "The quick brown fox jumps over the lazy dog. " * 5),
    (7, LONG), (8, "aaaa" * 200), (9, "Released under the MIT License.\nGrüße, Σίσυφος 漢字 <|endoftext|> x"), (9, "Released under the MIT License.\nGrüße, Σίσυφος 漢字 <|endoftext|> x"),
    (10, "x" * 5000), (None, "a row without an id, and with some more words than that so as to be long enough for a match of one hundred bytes"),
]
EXTRA = ["k", "t", "row", "xs", "n", "first", "kept", "band", "words", "left", "part", "length", "g", "salt", "shard", "quality", "size"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("lang", F.lit("en")).withColumn("source", F.lit(None).cast("string"))
    return df.select("*", *[F.lit(f"extra {c}").alias(c) for c in EXTRA])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(1, 9)] + [(None, 1, 0), (4, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog"), (2, None), (3, ""), (1, "the quick brown fox jumps over the lazy dog"), (4, "short one")], "item_id long, text string")


def bench_rows(spark):
    return spark.createDataFrame([], "item_id long, text string")


OPERATORS = {
    "tiling": lambda d, s: tiling.contamination(d, s["benchmark"]),
    "tokens": lambda d, s: token_counts.count_tokens(d, BYTES),
    "licenses": lambda d, s: licenses.scan(d),
    "packing": lambda d, s: packing.pack(d, WORDS),
    "neardup": lambda d, s: neardup.near_duplicates(d),
    "repeats": lambda d, s: repeats.remove_repeats(d, digest=True),
    "repeats_texts": lambda d, s: repeats.remove_repeats(d),
    "shards": lambda d, s: shards.shard(d),
    "rules": lambda d, s: decision_rules.judge(d, s["labels"]),
    "classifier": lambda d, s: cotraining.classify(d, s["labels"]),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_edges_and_empty(spark, docs, labels, benchmark, name):
    side = {"labels": labels, "benchmark": benchmark}
    n = OPERATORS[name](docs, side).count()
    if name == "tiling":
        assert n == 2 * 2  # two documents, and the item is there twice
    elif name == "packing":
        assert n >= len(ROWS)
    else:
        assert n == len(ROWS)
    assert OPERATORS[name](docs.limit(0), side).count() == 0
    nothing = {"labels": labels.limit(0), "benchmark": benchmark.limit(0)}
    assert OPERATORS[name](docs, nothing).count() == (0 if name == "tiling" else n)


def test_tokens(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    got = sorted(((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.count_tokens(docs, BYTES).collect()))
    want = sorted((k or 0, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for k, t in ROWS)
    assert got == want


def test_prefix_counts_are_exact():
    from tokenizers import Tokenizer

    library, c = Tokenizer.from_file(BYTES), token_counts.counter(BYTES)
    for word in (" internationalization", "aaaaaaaaaaaa", " Straßenbahn", "!!!!???", "zzyzx1234"):
        data = word.encode()
        counts = c.prefixes(data)
        for end in range(1, len(data) + 1):
            try:
                prefix = data[:end].decode()
            except UnicodeDecodeError:
                continue
            if len(c.split.findall(prefix)) == 1:
                assert counts[end] == len(library.encode(prefix, add_special_tokens=False).ids)
    text = "The cat sat on the mat, and it's   very\n\n happy."
    for budget in range(14):
        cut = c.truncate(text, budget)
        assert text.startswith(cut) and len(library.encode(cut, add_special_tokens=False).ids) <= budget


def test_packing_round_trip(docs):
    from tokenizers import Tokenizer

    import numpy as np

    library = Tokenizer.from_file(WORDS)
    want = []
    for k, t in ROWS:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        want += [(k or 0, p // 4096, p, len(own := ids[p : p + 4096]), zlib.crc32(np.asarray(own, dtype="<u4").tobytes())) for p in range(0, len(ids), 4096)]
    got = packing.pack(docs, WORDS).collect()
    assert sorted((r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    ends = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 4096


@pytest.mark.parametrize("seed", range(4))
def test_packing_plans_cover_the_histogram(seed):
    from collections import Counter

    r = random.Random(seed)
    histogram = Counter(r.choice([r.randint(1, 4096), r.randint(1, 300), 2049, 4096]) for _ in range(600))
    seen = Counter()
    for config, runs in packing.solve(histogram, 4096):
        assert sum(config) <= 4096
        for x in config:
            seen[x] += runs
    assert seen == histogram


def test_shards(docs):
    got = shards.shard(docs).collect()
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    where = {r["doc_id"]: r["shard"] for r in got}
    assert where[5] == where[6] and where[1] == where[2]


def test_smallest_capacity_is_smallest():
    r = random.Random(1)
    for _ in range(50):
        sizes = [r.randint(1, 30) for _ in range(r.randint(1, 20))]
        breaks, n = [], 0
        for s in sizes:
            n += s
            breaks.append(n)
        got, cuts = shards.smallest_capacity(breaks, 4)
        assert cuts[-1] == n and len(cuts) <= 4
        assert shards.greedy_cuts(breaks, got - 1, 4) is None


def test_repeats_against_brute_force(spark):
    r = random.Random(5)
    words = ["ab", "cde", "fghij", "k", "lmno pq", "aaaa", "é"]
    base = [" ".join(r.choice(words) for _ in range(r.randint(0, 120))) for _ in range(8)]
    rows = []
    for i in range(40):
        t = r.choice(base)
        if i % 3:
            cut = r.randint(0, len(t))
            t = t[:cut] + "XY" + t[cut + r.randint(0, 3) :] + r.choice(base)[: r.randint(0, 250)]
        rows.append((i, t if i % 11 else None))
    rows.append((3, rows[4][1]))
    got = sorted((x["doc_id"], x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), digest=True).collect())
    seen, want = set(), []
    for k, t in sorted(((k, (t or "").encode()) for k, t in rows)):
        gone = bytearray(len(t))
        for s in range(len(t) - 99):
            if t[s : s + 100] in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(t[s : s + 100])
        kept = bytes(b for b, x in zip(t, gone, strict=True) if not x)
        want.append((k, len(t), sum(gone), sum(gone[i] and not (i and gone[i - 1]) for i in range(len(t))), hashlib.sha256(kept).hexdigest()))
    assert got == sorted(want)


def test_near_duplicates_against_brute_force(spark):
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, k = [], 0
    for _ in range(12):
        base = [r.choice(vocabulary) for _ in range(r.randint(3, 160))]
        for _ in range(r.randint(1, 9)):
            own = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4, 8])):
                own[r.randrange(len(own))] = r.choice(vocabulary)
            rows.append((k, " ".join(own)))
            k += 1
    rows += [(k, None), (k + 1, ""), (k + 2, "W1 w2"), (k + 3, "w1  w2"), (k + 4, "w1")]
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[j : j + 3]) for j in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())
    least = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                    least[a] = least[b] = min(least[a], least[b])
    found = neardup.component_ids(neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)).collect()
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"], x["kept"]) for x in found} == {i: (len(s), least[i], least[i] == i) for i, s in sets.items()}


def test_recall_of_near_duplicates(spark):
    """Pairs at and just above the threshold, of many sizes: none may be missed."""
    r = random.Random(8)
    rows, want = [], {}
    for k in range(0, 600, 2):
        base = [f"t{k}x{i}" for i in range(r.randint(30, 400))]
        own, shingles = list(base), lambda w: {tuple(w[j : j + 3]) for j in range(len(w) - 2)}
        while True:
            tried = list(own)
            tried[r.randrange(len(tried))] = f"e{k}x{r.randint(0, 10**6)}"
            a, b = shingles(base), shingles(tried)
            if 100 * len(a & b) < 85 * len(a | b):
                break
            own = tried
        rows += [(k, " ".join(base)), (k + 1, " ".join(own))]
        want |= {k: k, k + 1: k}
    found = neardup.component_ids(neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)).collect()
    assert {x["doc_id"]: x["component_id"] for x in found} == want


def test_hot_groups_are_dealt_out(spark, monkeypatch):
    """With every key hot, results are the same."""
    from plumbline.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 1)
    monkeypatch.setattr(common, "HOT_KEYS", 10**9)
    test_near_duplicates_against_brute_force(spark)
    test_repeats_against_brute_force(spark)


def test_texts_of_one_id_are_taken_in_their_order(spark):
    """Four copies and one other text under one id, and a null id: the first in order stays."""
    same = "the same words of a text that is long enough to be removed where it comes again, as it is over one hundred bytes long"
    rows = [(1, "e " + same), (1, "a " + same), (1, "c " + same), (1, "b other"), (None, "z " + same), (2, None)]
    found = {r["k"]: r["row"]["text"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[k] for k in sorted(found)] == ["z " + same, "a " + same, "b other", "c " + same, "e " + same, None]
    left = sorted((r["doc_id"] or 0, r["text"]) for r in repeats.remove_repeats(spark.createDataFrame(rows[:5], "doc_id long, text string")).collect())
    assert left == [(0, "z " + same), (1, "a"), (1, "b other"), (1, "c"), (1, "e")]


def test_tiling_finds_reordered_passages(spark, docs):
    item = " ".join(f"tok{i}" for i in range(30))
    w = item.split()
    rows = [(1, "intro words here " + " ".join(w[15:]) + " filler, " + " ".join(w[:15])), (2, " ".join(w[:8])), (3, item.upper().replace(" ", ", ")), (4, " ".join(reversed(w)))]
    d, b = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r["doc_id"]: (r["n_tiles"], r["coverage"]) for r in tiling.contamination(d, b).collect()}
    assert got == {1: (2, 1.0), 3: (1, 1.0)}


def test_licenses(spark):
    rows = [(1, "Licensed under the Apache License, Version 2.0. MIT license; mit-license"), (2, "GNU GENERAL public\nlicense"), (3, "no license at all"), (4, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software")]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["base_labels"]) == (3, 3, 10, "apache,mit")
    assert (got[2]["n_base"], got[2]["base_labels"], got[2]["first_word"]) == (1, "gpl", 1)
    assert (got[3]["n_base"], got[3]["labels"], got[3]["score"], got[3]["first_word"]) == (0, "", 0.0, None)
    assert got[4]["labels"] == "mit" and got[4]["base_labels"] == "" and got[4]["score"] > 0.7


def test_rules_are_learned(spark):
    r = random.Random(2)
    good = [(i, " ".join(r.choice(["alpha", "beta", "gamma", "delta"]) + str(r.randint(0, 999)) for _ in range(80)), 1) for i in range(60)]
    bad = [(100 + i, " ".join(f"word{r.randint(0, 999)}***" for _ in range(80)), 0) for i in range(60)]
    d = spark.createDataFrame([x[:2] for x in good + bad], "doc_id long, text string")
    lab = spark.createDataFrame([(i, q, 0) for i, _, q in good + bad if i % 2], "doc_id long, quality int, toxic int")
    got = {x["doc_id"]: x["kept"] for x in decision_rules.judge(d, lab).collect()}
    assert sum(got[i] for i, _, _ in good) >= 59 and sum(got[i] for i, _, _ in bad) <= 1


PAGE = """<html><head><title>x</title><style>p{}</style></head><body><header class="site-header"><h1>My Site</h1><a href=x>home</a></header><nav>menu</nav>
<div class="cookie-notice">We use cookies to improve the site and you agree to that by using it.</div>
<main><article><h1>Title</h1><p>First &amp; <b>best</b>&nbsp;paragraph<br>of the page, and it is good.</p><div class="ad">Buy the best of the things.</div><p>Short.<script>var a="</p>";</script></article>
<section id="comments"><p>I like this article and it is the best that I have read.</p></section></main><aside>more</aside><form><p>Your name</p></form><footer>(c) 2020</footer></body></html>"""


def test_pages(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (3, "u", ""), (4, "u", "<p>a &lt; b<p>unfinished <a hr"), (5, "u", "plain"), (6, "u", "<p>" + "many words of the text " * 20000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("h", F.lit(1))
    out = [(r["page_id"], r["text"], r["n_chars"]) for r in html_text.extract(df).collect()]
    got = {k: t for k, t, _ in out}
    assert got[1] == "Title\n\nFirst & best paragraph of the page, and it is good.\n\nShort."
    assert got[2] == got[3] == "" and got[4] == "a < b\n\nunfinished" and got[5] == "plain" and got[6].startswith("many words")
    assert all(n == len(t) for _, t, n in out) and len(out) == len(rows)
    assert html_text.extract(df.limit(0)).count() == 0
