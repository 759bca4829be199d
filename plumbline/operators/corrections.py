"""Selecting and correcting one source's observations: series, scopes, histories, floors by tenure, frames, abstaining views."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Placeholders of a series' name and the form of what they stand for (a digit by 0).
PLACEHOLDERS = {"YYYY-Www": "0000-W00", "YYYY-MM": "0000-00"}


def of_series(column: Column, series: str) -> Column:
    """Whether a series' name is this one, read piece by piece: fixed text as it is, a period where a placeholder stands."""
    pieces = re.split("(" + "|".join(PLACEHOLDERS) + ")", series)
    ok, at = F.lit(True), 1
    for piece in pieces:
        here = F.substring(column, at, len(piece)) if piece not in PLACEHOLDERS else F.translate(F.substring(column, at, len(PLACEHOLDERS[piece])), "123456789", "000000000")
        ok = ok & (here == PLACEHOLDERS.get(piece, piece))
        at += len(PLACEHOLDERS.get(piece, piece))
    return ok & (F.length(column) == at - 1)


def in_scopes(key: Column, scopes: list[str]) -> Column:
    """Whether a package key, '@scope/name' or 'pkg:npm/%40scope/name', is of one of the scopes; all are without scopes."""
    if not scopes:
        return F.lit(True)
    scope = F.regexp_extract(key, r"^(?:pkg:npm/)?(?:@|%40)([^/]+)/", 1)
    return scope.isin([s.lstrip("@") for s in scopes])


def selected(obs: DataFrame, collector: str, series: str, scopes: list[str] = (), early: list[str] = (), left_out: list[str] = (), methods: list[str] = ()) -> DataFrame:
    """Observations (source, series, key, prerelease, repo, base, packaged, method) that an engine source reads.

    Prereleases count for the repositories in `early` alone; assets in left_out, unpackaged keys and
    other methods don't. Missing attributes never exclude.
    """
    ok = (F.col("source") == collector) & of_series(F.col("series"), series) & in_scopes(F.col("key"), list(scopes))
    ok = ok & (~F.coalesce("prerelease", F.lit(False)) | F.coalesce(F.col("repo").isin(list(early)), F.lit(False)))
    ok = ok & ~F.coalesce(F.col("base").isin(list(left_out)), F.lit(False)) & F.coalesce("packaged", F.lit(True))
    return obs.where(ok & (F.col("method").isNull() | F.col("method").isin(list(methods)))) if methods else obs.where(ok)


def release_history(obs: DataFrame, mode: str, repo: str = "repo", tag: str = "release", day: str = "published", start: str = "start") -> DataFrame:
    """All releases, those of the last 24 months of the data ('24months'), or the latest 24 by repository ('latest24').

    A release without a day of publication counts from its observation's start.
    """
    since = F.coalesce(day, start)
    if mode == "24months":
        last = obs.agg(F.max("end").alias("_last"))
        return obs.join(F.broadcast(last)).where(since >= F.date_sub("_last", 730)).drop("_last")  # one row
    if mode == "latest24":
        turn = Window.partitionBy(repo).orderBy(F.desc("_since"), F.desc(tag))
        releases = obs.select(repo, tag, since.alias("_since")).distinct().withColumn("_n", F.row_number().over(turn)).where("_n <= 24")
        return obs.join(releases.select(repo, tag).distinct(), [repo, tag], "left_semi")
    return obs


def total(value: Column) -> Column:
    """Sum of what is known; null if nothing is."""
    return F.sum(value)


def plain_counts(obs: DataFrame, keys: list[str], value: str, first: str, end: str) -> DataFrame:
    """Values as they are ('current', 'yearly'): total, first day seen, last day of the data, by key."""
    return obs.groupBy(*keys).agg(total(F.col(value)).alias("value"), F.min(first).alias("start"), F.max(end).alias("end"))


def months_between(start: Column, end: Column) -> Column:
    """Whole months from start's to end's, both counted; without a start there is no end to them."""
    return F.when(start.isNull(), F.lit(2**31 - 1)).otherwise((F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start) + 1)


def group_members(relations: DataFrame, group: str) -> DataFrame:
    """Members of a package group (member, joined: the earliest day an edge gives, null if none does), from either end of an edge."""
    edges = relations.where("kind = 'group'")
    one = edges.where(F.col("subject") == group).select(F.col("object").alias("member"), "first_seen")
    other = edges.where((F.col("object") == group) & (F.col("subject") != group)).select(F.col("subject").alias("member"), "first_seen")
    return one.unionByName(other).groupBy("member").agg(F.min("first_seen").alias("joined"))


def tenured_floor(values: DataFrame, members: DataFrame, key: str, value: str, start: str, end: str, months: int, q: float) -> DataFrame:
    """Values of group members of some tenure less the q quantile of their positive ones, not below 0; others as they are."""
    both = values.join(members.withColumnRenamed("member", key), key, "left").join(members.select(F.col("member").alias(key), F.lit(True).alias("_in")), key, "left")
    long = F.coalesce("_in", F.lit(False)) & (months_between(F.coalesce("joined", start), F.col(end)) >= months)
    both = both.withColumn("_long", long)
    floor = both.where(F.col("_long") & (F.col(value) > 0)).agg(F.percentile(value, q).alias("_floor"))
    above = F.when(F.col("_long") & (F.col(value) > 0), F.greatest(F.col(value) - F.coalesce("_floor", F.lit(0.0)), F.lit(0.0))).otherwise(F.col(value))
    return both.join(F.broadcast(floor)).withColumn("above", above).drop("_in", "_long", "_floor", "joined")  # one row


def framed(terms: DataFrame, frame: DataFrame, keys: list[str]) -> DataFrame:
    """Terms completed to their frame: what the frame has beyond them is censored for want of a value."""
    out = terms.join(frame.select(*keys, F.lit(True).alias("_f")).distinct(), keys, "full_outer")
    return out.withColumn("state", F.coalesce("state", F.lit("censored:no_value"))).drop("_f")


def without_abstaining(terms: DataFrame, abstaining: DataFrame, views: list[str], family: str) -> DataFrame:
    """Terms by view (view, source, family) without those of a source that abstains for a family, in the abstaining views."""
    gone = abstaining.select("source", family).distinct().withColumn("_gone", F.lit(True))
    out = terms.join(gone, ["source", family], "left")
    return out.where(~(F.col("view").isin(views) & F.col("_gone").isNotNull())).drop("_gone")


#: How the ids of the kinds of cases begin, and the answer that overrules one.
CASES, OVERRULED = {"preinstalled": "pre", "dependency": "dep", "review": "rev"}, "b"


def cases(abstaining: DataFrame, shares: DataFrame, terms: DataFrame, rulings: DataFrame, abstain: float, review: float, family: str) -> DataFrame:
    """Cases for the owner (case, kind, source, family, share, status) on families that the source has a term for.

    abstaining has a row by source and family with why ('preinstalled' or 'dependency') and share; shares
    the largest dependency share by source and family. A share of `abstain` or more makes a dependency
    case, one of `review` or more a review case, where the family doesn't abstain already; a preinstalled
    case that was overruled leaves it to its share. rulings (case, answer): none makes a case new.
    """
    ruled = rulings.select("case", F.when(F.col("answer") == OVERRULED, "overruled").otherwise("accepted").alias("_status"))

    def named(df: DataFrame) -> DataFrame:
        prefix = F.create_map(*[F.lit(x) for kind in CASES.items() for x in kind])[F.col("kind")]
        out = df.withColumn("case", case_id(F.concat_ws("-", prefix, "source", F.col(family).cast("string"))))
        return out.join(ruled, "case", "left").select("case", "kind", "source", family, "share", F.coalesce("_status", F.lit("new")).alias("status"))

    has = terms.select("source", family).distinct()
    first = named(abstaining.select("source", family, F.col("why").alias("kind"), "share").join(has, ["source", family], "left_semi"))
    settled = first.where((F.col("kind") == "dependency") | (F.col("status") != "overruled"))
    kind = F.when(F.round("share", 6) >= abstain, "dependency").when(F.round("share", 6) >= review, "review")
    rest = shares.select("source", family, F.round("share", 6).alias("share"), kind.alias("kind")).where("kind is not null")
    rest = rest.join(has, ["source", family], "left_semi").join(settled.select("source", family), ["source", family], "left_anti")
    return first.unionByName(named(rest))


def case_id(base: Column) -> Column:
    """A question's id of 64 characters at most; a longer one is cut and told apart by its digest."""
    return F.when(F.length(base) <= 64, base).otherwise(F.concat_ws("-", F.substring(base, 1, 55), F.substring(F.sha2(base, 256), 1, 8)))


#: Words of a width, words of degree that may stand before one, and the weight that counts as one.
WIDTHS, DEGREES, HEAVY = ("condensed", "narrow", "compressed"), ("semi", "extra", "ultra"), "black"


def without_width(name: Column) -> Column:
    """A name without a width at its end, with the word of degree before it, or joined to it; only whole words count, and null if it ends in none."""
    words = F.split(F.trim(name), r"\s+")
    n, last = F.size(words), F.lower(F.element_at(words, -1))
    joined = [f"{d}{mark}{w}" for w in WIDTHS for d in DEGREES for mark in ("", "-")]
    degree = F.lower(F.get(words, n - 2)).isin(*DEGREES)
    taken = F.when(last.isin(*WIDTHS), F.when(degree, 2).otherwise(1)).when(last.isin(HEAVY, *joined), 1)
    return F.when(n > taken, F.array_join(F.slice(words, 1, n - taken), " "))


def width_parents(names: DataFrame, name: str, fold: Callable[[Column], Column]) -> DataFrame:
    """(name, parent): names that are another one, by their folded forms, with a width behind it."""
    own = names.select(name, fold(without_width(F.col(name))).alias("_fold")).where("_fold is not null")
    other = names.select(F.col(name).alias("parent"), fold(F.col(name)).alias("_fold"))
    return own.join(other, "_fold").where(F.col(name) != F.col("parent")).select(name, "parent")


def shares_repository(a: DataFrame, b: DataFrame, family: str, repos: str) -> DataFrame:
    """Families of a whose repositories meet those of b."""
    both = a.select(family, F.col(repos).alias("_a")).join(b.select(family, F.col(repos).alias("_b")), family)
    return both.select(family, F.coalesce(F.arrays_overlap("_a", "_b"), F.lit(False)).alias("same"))


def ruler_counts(keys: DataFrame, family: str, value: str, known: DataFrame) -> DataFrame:
    """The ruler's counts: sums without a floor; 0 for known families without a row."""
    sums = keys.groupBy(family).agg(F.sum(value).alias("count"))
    return known.select(family).distinct().join(sums, family, "full_outer").withColumn("count", F.coalesce("count", F.lit(0.0)))


def state_counts(terms: DataFrame, view: str) -> DataFrame:
    """How many terms of each state a source has in each view."""
    return terms.groupBy(view, "source", "state").agg(F.count(F.lit(1)).alias("n"))
