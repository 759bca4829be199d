"""Package versions against a comparison character by character, ranges against counts, windows and thresholds."""

import functools
import random

from pyspark.sql import functions as F

from plumbline.operators import backtest, lists
from plumbline.sources import records


def split(v):
    epoch, colon, rest = v.partition(":")
    if not colon:
        epoch, rest = "0", v
    up, dash, rev = rest.rpartition("-")
    return int(epoch or 0), *((up, rev) if dash else (rest, ""))


def part(a, b):
    """The manager's own walk: other characters one by one (tilde, end, letters, rest), then numbers."""
    weight = lambda c: -1 if c == "~" else ord(c) if c.isalpha() else ord(c) + 256
    while a or b:
        while (a and not a[0].isdigit()) or (b and not b[0].isdigit()):
            x = weight(a[0]) if a and not a[0].isdigit() else 0
            y = weight(b[0]) if b and not b[0].isdigit() else 0
            if x != y:
                return x - y
            a, b = a[1:], b[1:]
        n = next((k for k, c in enumerate(a) if not c.isdigit()), len(a))
        m = next((k for k, c in enumerate(b) if not c.isdigit()), len(b))
        if int(a[:n] or 0) != int(b[:m] or 0):
            return int(a[:n] or 0) - int(b[:m] or 0)
        a, b = a[n:], b[m:]
    return 0


def compare(a, b):
    x, y = split(a), split(b)
    return (x[0] > y[0]) - (x[0] < y[0]) or part(x[1], y[1]) or part(x[2], y[2])


def test_version_keys_sort_as_the_manager_does(spark):
    r = random.Random(8)
    versions = ["1.0", "1.0~", "1.0~~", "1.0a", "1.0+b", "1.0-1", "1.0-", "0:1.0", "2:0", "1.00", "1.0.0", "", "~", "1.0-1-1", "a", "1", "10", "9", "12345678901234567890123"]
    versions += ["".join(r.choice("019~ab+.-") for _ in range(r.randrange(1, 8))) for _ in range(150)] + [f"{r.randrange(3)}:{r.choice('12')}.{r.choice('ab~')}" for _ in range(20)]
    keys = {x["v"]: x["k"] for x in spark.createDataFrame([(v,) for v in versions], "v string").select("v", records.version_key(F.col("v")).alias("k")).collect()}
    for a in versions:
        for b in versions:
            want = compare(a, b)
            assert (keys[a] > keys[b]) - (keys[a] < keys[b]) == (want > 0) - (want < 0), (a, b)
    rows = [(p, r.choice(versions), p) for p in ("x", "y", " ", None) for _ in range(30)]
    got = {x["p"]: x["v"] for x in records.latest_versions(spark.createDataFrame(rows, "p string, v string, c string"), "p", "v").collect()}
    assert set(got) == {"x", "y"}
    for p in got:
        own = [v for q, v, _ in rows if q == p]
        assert compare(got[p], max(own, key=functools.cmp_to_key(compare))) == 0
    assert spark.createDataFrame([(None,)], "v string").select(records.version_key(F.col("v"))).first()[0] is None


def test_quantile_ranges_and_widening(spark):
    r = random.Random(3)
    scores = [(p, k, float(r.randrange(12))) for p in "ab" for k in range(40)]
    probes = [(p, k, x - r.randrange(4) * 0.5, x + r.randrange(4) * 0.5) for p, k, x in scores] + [("a", 99, 3.0, None), ("c", 1, 1.0, 2.0)]
    out = lists.quantile_ranges(spark.createDataFrame(scores, "p string, k long, score double"), spark.createDataFrame(probes, "p string, k long, low double, high double"), ["p"], "k").collect()
    got = {(x["p"], x["k"]): (x["best"], x["worst"]) for x in out}
    for p, k, low, high in probes:
        others = [x for q, j, x in scores if q == p and j != k]
        assert got[p, k] == tuple(None if v is None else 1 + sum(x > v for x in others) for v in (high, low))
    wide = lists.holding(spark.createDataFrame([(3, 5, 7), (3, 5, 4)], "low int, high int, rank int"), "low", "high", "rank").collect()
    assert [tuple(x) for x in wide] == [(3, 7, 7), (3, 5, 4)]


def test_windows_of_short_runs_and_thresholds(spark):
    values = [("a", "x", m, 1.0) for m in (5, 6, 7)] + [("a", "y", 6, 4.0), ("b", "x", 3, 1.0), ("c", "x", 1, 1.0), ("c", "x", 3, 2.0), ("c", "x", 4, 5.0)]
    got = sorted(tuple(x) for x in backtest.monthly_windows(spark.createDataFrame(values, "s string, i string, m int, v double"), "s", "i", "m", "v", 12).collect())
    assert got == [("a", 5, 6, "x", 2.0), ("a", 5, 6, "y", 4.0), ("a", 6, 7, "x", 2.0), ("a", 6, 7, "y", 4.0), ("c", 3, 3, "x", 2.0), ("c", 4, 4, "x", 5.0)]
    pairs = spark.createDataFrame([(0.981, 1.204, None), (0.95, None, None)], "rho double, jump double, coverage double")
    assert {x["threshold"]: x["value"] for x in backtest.suggested(pairs).collect()} == {"spearman_min": 0.93, "share_jump_max": 1.23}
