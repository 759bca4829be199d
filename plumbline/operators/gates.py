"""Gates and facts of families: scripts, glyph coverage, first source wins, licence text prints, age shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Scripts whose families count as CJK.
CJK = ["Hani", "Hans", "Hant", "Hira", "Kana", "Hrkt", "Jpan", "Hang", "Kore", "Bopo"]


def script_verdict(script: Column, subsets: Column) -> Column:
    """'pass' for a Latin primary script with a Latin subset, else why not, in fixed order."""
    latin = F.array_contains(subsets, "latin")
    return F.when(script.isin("", "Latn") & latin, "pass").when(script.isin(*CJK), "cjk").when(~latin, "no_latin_subset").otherwise("dual_script")


def glyph_coverage(df: DataFrame, points: str, kernel: list[int], partial: float) -> DataFrame:
    """df with missing (kernel code points without a glyph), share (4 decimals) and verdict."""
    lacks = F.size(F.array_except(F.array(*[F.lit(x) for x in kernel]), F.col(points)))
    share = F.round(1 - lacks / len(kernel), 4)
    return df.withColumn("missing", lacks).withColumn("share", share).withColumn("verdict", F.when(lacks == 0, "pass").when(share >= partial, "partial").otherwise("fail"))


def first_of(facts: DataFrame, keys: list[str], value: str, source: str, order: list[str], ties: list[str]) -> DataFrame:
    """Each key's value of the first source in order that has one; ties go by the given columns."""
    place = F.array_position(F.array(*[F.lit(s) for s in order]), F.col(source))
    known = facts.where(F.col(value).isNotNull() & (place > 0))
    return known.groupBy(*keys).agg(F.min_by(F.struct(value, source), F.struct(place, *ties)).alias("_f")).select(*keys, "_f.*")


def age_share(first_seen: Column, end: Column, days: int) -> Column:
    """Share of a window that a family has existed for; 1 where its first day is unknown."""
    return F.when(first_seen.isNull(), 1.0).otherwise(F.least(F.greatest(F.datediff(end, first_seen) / days, F.lit(0.0)), F.lit(1.0)))
