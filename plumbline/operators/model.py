"""Measurement model of latent popularity: negative-binomial counts integrated over a grid, as column expressions.

Every family has a latent score with a standard normal prior; each term (a source's count) has the
mean e * (n * bulk + exp(alpha + lam * score)). The grid is a fixed literal array, so a family's
likelihood, posterior and quantiles come from one grouping by family: no node is ever a row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.kernel import once

#: Ends and step of the grid (a fixed number of nodes).
LOW, HIGH, STEP = -6.0, 7.0, 0.05
#: Places that lgamma moves its argument up before Stirling's series is good enough.
SHIFT = 7
#: What a term brings to a family's likelihood.
PARTS = ["term", "y", "n", "e", "alpha", "lam", "bulk", "k"]


def lgamma(x: Column) -> Column:
    """Logarithm of the gamma function for x > 0: Stirling's series at x + SHIFT, and back."""
    z = x + SHIFT
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    down = F.log(x)
    for k in range(1, SHIFT):
        down = down + F.log(x + k)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - down


def nodes() -> list[tuple[float, float]]:
    """(score, log weight) of the grid: trapezoid rule under the standard normal density."""
    count = round((HIGH - LOW) / STEP) + 1
    xs = [LOW + STEP * i for i in range(count)]
    return [(x, math.log(STEP * (0.5 if i in (0, count - 1) else 1.0)) - x * x / 2 - 0.5 * math.log(2 * math.pi)) for i, x in enumerate(xs)]


def grid() -> Column:
    return F.array(*[F.struct(F.lit(x).alias("x"), F.lit(w).alias("w")) for x, w in nodes()])


def mean(t: Column, x: Column) -> Column:
    """Bulk and popularity: what a term expects of a family of score x."""
    return t["e"] * (t["n"] * t["bulk"] + F.exp(t["alpha"] + t["lam"] * x))


def log_pmf(t: Column, x: Column) -> Column:
    """Negative-binomial log-probability of t's count, without the part that no score changes (t['c'])."""
    return once(mean(t, x), lambda m: t["k"] * F.log(t["k"] / (t["k"] + m)) + t["y"] * F.log(m / (t["k"] + m)))


def constant(y: Column, k: Column) -> Column:
    return lgamma(y + k) - lgamma(k) - lgamma(y + 1)


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + v)


def weighed(terms: DataFrame, keys: list[str]) -> DataFrame:
    """By keys: ts (the terms), top, p (likelihood times prior at each node, the highest one being 1) and their sum, whole.

    Keys are dealt out over all tasks by number: their rows are small, but the work on each is not.
    """
    tasks = 3 * terms.sparkSession.sparkContext.defaultParallelism
    own = terms.withColumn("c", constant(F.col("y"), F.col("k"))).repartition(tasks, *keys)
    by = own.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*PARTS, "c"))).alias("ts"))
    logs = F.transform(F.col("g"), lambda g: g["w"] + F.aggregate("ts", F.lit(0.0), lambda a, t: a + t["c"] + log_pmf(t, g["x"])))
    by = by.withColumn("g", grid()).withColumn("l", logs).withColumn("top", F.array_max("l"))
    return by.withColumn("p", F.transform("l", lambda v: F.exp(v - F.col("top")))).drop("l").withColumn("whole", total(F.col("p")))


def quantile(q: float) -> Column:
    """Where the posterior reaches q; a node's weight is spread evenly over its cell."""
    start = F.struct(F.lit(0.0).alias("cum"), F.lit(None).cast("double").alias("out"))

    def step(a: Column, n: Column) -> Column:
        share = n["p"] / F.col("whole")
        here = n["g"]["x"] - STEP / 2 + STEP * (q - a["cum"]) / share
        return F.struct((a["cum"] + share).alias("cum"), F.coalesce(a["out"], F.when(a["cum"] + share >= q, here)).alias("out"))

    return F.aggregate(F.arrays_zip("g", "p"), start, step, lambda a: a["out"])


def posterior(terms: DataFrame, keys: list[str], quantiles: tuple[float, ...] = ()) -> DataFrame:
    """By keys: mean, sd, evidence (log marginal likelihood) and the quantiles q0, q1, ...

    terms: a row per key and term with term, y, n, e, alpha, lam, bulk, k (doubles). Null counts are
    to be left out before; a key without terms has no row.
    """
    w = weighed(terms, keys)
    whole = F.col("whole")
    first = total(F.zip_with("g", "p", lambda g, p: g["x"] * p)) / whole
    second = total(F.zip_with("g", "p", lambda g, p: g["x"] * g["x"] * p)) / whole
    cols = [first.alias("mean"), F.sqrt(F.greatest(second - first * first, F.lit(0.0))).alias("sd"), (F.col("top") + F.log(whole)).alias("evidence")]
    return w.select(*keys, *cols, *[quantile(q).alias(f"q{i}") for i, q in enumerate(quantiles)])


def information_shares(terms: DataFrame, keys: list[str]) -> DataFrame:
    """By keys and term: its share of what the terms tell about the score (mean curvature under the posterior)."""
    w = weighed(terms, keys).select(*keys, "g", "p", "whole", F.explode("ts").alias("t"))
    l = F.transform("g", lambda g: log_pmf(F.col("t"), g["x"]))  # noqa: E741
    bend = F.transform(
        F.sequence(F.lit(1), F.size("l") - 2),
        lambda i: F.get(F.col("p"), i) * (2 * F.get(F.col("l"), i) - F.get(F.col("l"), i - 1) - F.get(F.col("l"), i + 1)) / STEP**2,
    )
    told = w.withColumn("l", l).select(*keys, F.col("t.term").alias("term"), F.greatest(total(bend) / F.col("whole"), F.lit(0.0)).alias("info"))
    every = F.sum("info").over(Window.partitionBy(*keys))
    return told.withColumn("share", F.when(every > 0, F.col("info") / every))


def log_sum_moments(bulk: Column, popularity: Column, tau: Column, sigma: Column) -> tuple[Column, Column]:
    """Mean and sd of the logarithm of bulk * e^(tau Z1) + popularity * e^(sigma Z2), by the log-normal of equal mean and variance (Fenton and Wilkinson).

    In logs, so that neither part overflows; a part of nothing counts as 1e-300.
    """
    b = F.log(F.greatest(bulk, F.lit(1e-300))) + tau * tau / 2
    p = F.log(F.greatest(popularity, F.lit(1e-300))) + sigma * sigma / 2
    whole = F.greatest(b, p) + F.log1p(F.exp(-F.abs(b - p)))
    spread = F.log1p(F.exp(2 * (b - whole)) * F.expm1(tau * tau) + F.exp(2 * (p - whole)) * F.expm1(sigma * sigma))
    return whole - spread / 2, F.sqrt(spread)
