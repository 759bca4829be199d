"""Survey scoring end to end: weights, groups, one survey's places, the overall fusion, published places, reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators import scoring


def effective_weights(nominal: DataFrame, overlaps: DataFrame, full: int, off: int, groups: DataFrame | None = None, dropped: list[str] = ()) -> DataFrame:
    """(source, w): nominal (source, w, group) times the overlap scale of n in overlaps (source, n); 0 for dropped sources.

    groups (group, share): a group keeps its fixed share, split in proportion among its sources; one
    whose weights are all 0 contributes nothing. Sources are a bounded table.
    """
    both = nominal.join(overlaps, "source", "left")
    own = F.when(F.col("source").isin(list(dropped)), 0.0).otherwise(F.col("w") * scoring.overlap_scale(F.coalesce("n", F.lit(0)), full, off))
    out = both.withColumn("w", own)
    if groups is None:
        return out.select("source", "w")
    total = F.sum("w").over(Window.partitionBy("group"))
    return out.join(groups, "group").select("source", F.when(total > 0, F.col("share") * F.col("w") / total).otherwise(0.0).alias("w"))


def mix_weights(weights: DataFrame, mix: DataFrame) -> DataFrame:
    """(source, w) of a fusion of keys: weights (key, source, w), mix (key, share); a source of two keys is an error."""
    total = F.sum("w").over(Window.partitionBy("key"))
    out = weights.join(mix, "key").withColumn("w", F.when(total > 0, F.col("share") * F.col("w") / total).otherwise(0.0))
    twice = F.count(F.lit(1)).over(Window.partitionBy("source")) > 1
    return out.select("source", F.when(twice, F.raise_error(F.concat(F.col("source"), F.lit(" feeds two keys of the mix"))).cast("double")).otherwise(F.col("w")).alias("w"))


def groups_of(terms: DataFrame, family: str, group: str, state: str, gate_only: Column) -> DataFrame:
    """By family: n_observed, groups (of observed terms that score), gate_groups (of observed ones that only count for the gate, and are not among groups)."""
    seen = F.col(state) == "observed"
    by = terms.groupBy(family).agg(
        F.count_if(seen & ~gate_only).alias("n_observed"),
        F.array_sort(F.collect_set(F.when(seen & ~gate_only, F.col(group)))).alias("groups"),
        F.array_sort(F.collect_set(F.when(seen & gate_only, F.col(group)))).alias("_gate"),
    )
    return by.select(family, "n_observed", "groups", F.array_except("_gate", "groups").alias("gate_groups"))


def score(terms: DataFrame, ruler: DataFrame, weights: DataFrame, family: str, guard: dict, whole: float | Column) -> DataFrame:
    """Terms (source, family, x, state) equated, with w, z and guard: censored ones lie below all observed ones of their source."""
    x = F.when(F.col("state") == "observed", F.col("x")).when(F.col("state") == "censored", F.lit(float("-inf")))
    used = terms.withColumn("x", x).where("x is not null").join(F.broadcast(weights.where("w > 0")), "source")  # a row by source
    z = scoring.equate(used.select("source", family, "x"), ruler, "source", family, "x")
    return scoring.guarded(used.drop("x").join(z.drop("x"), ["source", family]), [family], **guard)


def placed(scored: DataFrame, groups: DataFrame, family: str, top: int, least_groups: int = 2, least_observed: int = 1, ruler_z: str | None = None, name: Column | None = None) -> DataFrame:
    """Places of the families with enough observed terms; the gate asks for groups among score and gate-only terms.

    Equal scores go by weight, then by the ruler's z (none comes last), then by the folded name, then by id.
    """
    both = scored.join(groups, family).where(F.col("n_observed") >= least_observed)
    both = both.withColumn("passes", F.size("groups") + F.size("gate_groups") >= least_groups)
    ties = ([F.desc_nulls_last(ruler_z)] if ruler_z else []) + ([F.lower(name)] if name is not None else [])
    return scoring.placed(both, "score", [F.desc("score"), F.desc("weight"), *ties, family], "passes", top)


def overall(parts: DataFrame, weights: DataFrame, family: str, kappa: float = 0.2) -> DataFrame:
    """One shrunk fusion of all keys' equated terms (source, family, z, guard) at weights (source, w); guards stay as each survey gave them."""
    whole = weights.agg(F.sum("w").alias("_whole"))
    t = parts.drop("w").join(F.broadcast(weights), "source").join(F.broadcast(whole))  # a row by source, one row
    out = t.where("w > 0").groupBy(family).agg(F.sum(F.col("w") * F.col("guard") * F.col("z")).alias("_wz"), F.sum(F.col("w") * F.col("guard")).alias("weight"), F.min("z").alias("_low"), F.max("z").alias("_high"), F.first("_whole").alias("_whole"))
    raw = F.col("_wz") / (kappa * F.col("_whole") + F.col("weight"))
    return out.select(family, "weight", F.least(F.greatest(raw, F.least("_low", F.lit(0.0))), F.greatest("_high", F.lit(0.0))).alias("score"))


def published(placed: DataFrame, parts: list[str], family: str, top: int, held: DataFrame) -> DataFrame:
    """Places as published: unranked ones moved past the exact top, held families (family) left out and the ranks behind each closed up."""
    first = placed.groupBy(*parts).agg(F.min(F.when(F.col("rank").isNull(), F.col("place"))).alias("_first"))
    shift = F.greatest(F.coalesce(top + 1 - F.col("_first"), F.lit(0)), F.lit(0))
    gone = placed.join(held.select(family), family, "left_semi").where("rank is not null").groupBy(*parts).agg(F.array_sort(F.collect_list("place")).alias("_gone"))  # `top` numbers at most
    kept = placed.join(held.select(family), family, "left_anti").join(first, parts).join(gone, parts, "left")
    before = F.size(F.filter(F.coalesce("_gone", F.array().cast("array<bigint>")), lambda g: g < F.col("place")))
    return kept.withColumn("published", F.when(F.col("rank").isNull(), F.col("place") + shift).otherwise(F.col("place") - before).cast("long")).drop("_first", "_gone")


def unranked_reasons(listed: DataFrame, placed: DataFrame, view: DataFrame, reference: DataFrame, live: list[str], family: str) -> DataFrame:
    """Why listed families have no place: a live source observed them in the reference view only, else they are too new, else there is no evidence."""
    bare = listed.select(family).distinct().join(placed.select(family), family, "left_anti")
    ref = reference.where((F.col("state") == "observed") & F.col("source").isin(live)).select("source", family)
    lost = ref.join(view.select("source", family), ["source", family], "left_anti").select(family, F.lit(True).alias("_lost")).distinct()
    new = view.where("state = 'too_new'").select(family, F.lit(True).alias("_new")).distinct()
    out = bare.join(lost, family, "left").join(new, family, "left")
    return out.select(family, F.when(F.col("_lost"), "no_deliberate_evidence").when(F.col("_new"), "too_new").otherwise("no_evidence").alias("reason"))
