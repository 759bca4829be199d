"""The ranking core: ruler, equating, overlap scale, outlier guard, fusion, placement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.kernel import hazen_position, prefix_counts, probit, running, tie_blocks, with_midrank
from plumbline.sources.records import written

#: Places that the pool's blocks and the wanted places are joined by at once.
SPAN = 1024


def ruler(counts: DataFrame, family: str, count: str) -> DataFrame:
    """z of each family on the common scale: the probit of its count's mid-rank; ties share it."""
    ranked = with_midrank(counts.select(family, F.col(count).cast("double").alias("_x"), F.lit(0).alias("_all")), ["_all"], "_x")
    return ranked.select(family, probit(F.col("p")).alias("z"))


def equate(terms: DataFrame, ruler_z: DataFrame, source: str, family: str, value: str) -> DataFrame:
    """Every source's values on the ruler's scale.

    The families that a source shares with the ruler are its pool. A value's mid-rank in the pool
    (one more is counted in for a family off the ruler whose value the pool lacks) is looked up
    among the pool's z by Hazen's quantile. A source without a pool gives nothing.
    """
    terms = written(terms, "terms")  # each is read several times: as blocks, as values, and in the end
    on = written(terms.join(ruler_z.select(family, "z"), family).select(source, family, value, "z"), "pools")
    blocks = tie_blocks(on, [source], value).select(source, F.col(value).alias("_v"), "lower", "here", "n")
    values = terms.select(source, F.col(value).alias("_v")).distinct()
    sizes = blocks.groupBy(source).agg(F.max("n").alias("n"))
    # Values that the pool lacks stand between its values: their rank is what lies below them.
    every = values.join(blocks.select(source, "_v", "here"), [source, "_v"], "left").withColumn("here", F.coalesce("here", F.lit(0)))
    placed = prefix_counts(every, [source], "_v", "here").join(sizes, source)
    lower, upper = F.col("before"), F.col("before") + F.col("here")
    p = F.when(F.col("here") > 0, (lower + upper) / (2 * F.col("n"))).otherwise((lower + upper + 1) / (2 * (F.col("n") + 1)))
    placed = placed.withColumn("h", hazen_position(p, F.col("n"))).select(source, "_v", "h")

    # The pool's z by place: a tie block of z holds the places low to high. Blocks and wanted places
    # meet in ranges of SPAN places, so a block of any size is a row for each range, not for each member.
    steps = tie_blocks(on, [source], "z").select(source, "z", (F.col("lower") + 1).alias("low"), (F.col("lower") + F.col("here")).alias("high"))
    steps = steps.withColumn("_span", F.explode(F.sequence(F.floor(F.col("low") / SPAN), F.floor(F.col("high") / SPAN))))
    wanted = placed.withColumn("_k", F.explode(F.array_distinct(F.array(F.floor("h").cast("long"), F.ceil("h").cast("long"))))).withColumn("_span", F.floor(F.col("_k") / SPAN))
    found = wanted.join(steps, [source, "_span"]).where(F.col("_k").between(F.col("low"), F.col("high")))
    ends = found.groupBy(source, "_v").agg(F.min_by("z", "_k").alias("z0"), F.max_by("z", "_k").alias("z1"), F.min("h").alias("h"), F.min("_k").alias("_k0"))
    z = F.col("z0") + (F.col("h") - F.col("_k0")) * (F.col("z1") - F.col("z0"))
    return written(terms.join(ends.select(source, F.col("_v").alias(value), z.alias("z")), [source, value]), "equated")


def overlap_scale(n: Column, full: int = 50, off: int = 15) -> Column:
    """How far a source of n families shared with the ruler counts."""
    return F.when(n < off, 0.0).otherwise(F.least(F.lit(1.0), n / full))


def guarded(terms: DataFrame, keys: list[str], z: str = "z", gap: float = 1.5, least: int = 3, factor: float = 0.5, basis: str = "median") -> DataFrame:
    """Terms with `guard`: factor where z lies further than gap from the middle of its family's terms (of the others).

    All terms are judged at once, and only where there are `least` of them. A family's terms are as
    many as there are sources, so the window is small.
    """
    w = Window.partitionBy(*keys)
    n = F.count(z).over(w)
    middle = F.median(z).over(w) if basis == "median" else (F.sum(z).over(w) - F.col(z)) / (n - 1)
    return terms.withColumn("guard", F.when((n >= least) & (F.abs(F.col(z) - middle) > gap), factor).otherwise(1.0))


def fused(terms: DataFrame, keys: list[str], weight: str, whole: float | Column, z: str = "z", kappa: float = 0.2, mu: float = 0.0) -> DataFrame:
    """By family: the weighted mean of its z, drawn to mu by kappa of the survey's whole weight, within their range."""
    some = terms.where(F.col(weight) > 0)
    w, prior = F.col(weight) * F.col("guard"), (whole if isinstance(whole, Column) else F.lit(float(whole))) * kappa
    out = some.groupBy(*keys).agg(F.sum(w * F.col(z)).alias("_wz"), F.sum(w).alias("weight"), F.min(z).alias("_low"), F.max(z).alias("_high"), F.count(F.lit(1)).alias("n_terms"))
    score = (prior * mu + F.col("_wz")) / (prior + F.col("weight"))
    low, high = (F.least("_low", F.lit(mu)), F.greatest("_high", F.lit(mu))) if kappa > 0 else (F.col("_low"), F.col("_high"))
    return out.withColumn("score", F.least(F.greatest(score, low), high)).drop("_wz", "_low", "_high")


def placed(scored: DataFrame, by: str, order: list, passes: str, top: int, parts: list[str] | None = None) -> DataFrame:
    """Places in a list whose exact top takes families that pass the gate only.

    The order falls by the numeric column `by` first. The first `top` passers have the places 1 to
    top. Families passed over before the last of them (all failing ones, if the top is never full)
    come next, then the rest, each in the order given. gate_held: failing, and within the first `top`
    of the order itself. A null verdict fails.
    """
    parts = parts or []
    ok = F.coalesce(F.col(passes), F.lit(False))
    scored = written(scored, "scored")
    ranked = running(scored, parts, by, order, {"_rn": F.lit(1), "_passers": ok.cast("int")}, falling=True)
    ranked = written(ranked, "ranked")
    filled = ranked.groupBy(*parts).agg(F.max(F.when(ok & (F.col("_passers") <= top), F.col("_rn"))).alias("_last"), F.max("_passers").alias("_all"))
    ranked = ranked.join(filled, parts) if parts else ranked.join(F.broadcast(filled))  # one row
    first = ok & (F.col("_passers") <= top)
    over = ~ok & ((F.col("_all") < top) | (F.col("_rn") <= F.col("_last")))
    place = F.when(first, F.col("_passers")).when(over, F.least(F.col("_all"), F.lit(top)) + F.col("_rn") - F.col("_passers")).otherwise(F.col("_rn"))
    out = ranked.withColumn("place", place.cast("long")).withColumn("rank", F.when(first, F.col("place"))).withColumn("gate_held", ~ok & (F.col("_rn") <= top))
    return out.drop("_rn", "_passers", "_last", "_all")


def band(place: Column, rank: Column, bands: list[tuple[int, int]], open_from: int) -> Column:
    """Band of an unranked family; bands are closed, the last one is open."""
    at = F.greatest(place, F.lit(bands[0][0]))
    out = F.when(rank.isNotNull(), F.lit(None).cast("string"))
    for a, b in bands:
        out = out.when(at.between(a, b), f"{a}-{b}")
    return out.when(at >= open_from, f"{open_from}+")


def rrf(terms: DataFrame, source: str, family: str, rank: str, weight: str, whole: float, k: int = 60, kappa: float = 0.2) -> DataFrame:
    """Coverage-aware reciprocal rank fusion: sources that a family lacks are filled by a prior from the middle of each source."""
    middle = terms.groupBy(source).agg(F.count(F.lit(1)).alias("_n"), F.first(weight).alias("_w"))
    prior = middle.agg((F.sum(F.col("_w") / (k + (F.col("_n") + 1) / 2)) / F.sum("_w")).alias("_prior"))
    sums = terms.groupBy(family).agg(F.sum(F.col(weight) / (k + F.col(rank))).alias("_s"), F.sum(weight).alias("_w"))
    return sums.join(F.broadcast(prior)).select(family, ((kappa * whole * F.col("_prior") + F.col("_s")) / (kappa * whole + F.col("_w"))).alias("rrf"))
