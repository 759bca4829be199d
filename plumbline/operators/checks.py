"""Hard checks of a run's tables, and flags for its review: each a query of what is wrong, empty if nothing is."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def failure(rows: DataFrame, check: str, family: str, what: Column) -> DataFrame:
    return rows.select(F.lit(check).alias("check"), F.col(family).cast("string").alias("family"), what.alias("what"))


def ineligible_ranked(ineligible: DataFrame, tables: dict[str, DataFrame], family: str) -> DataFrame:
    """Ineligible families in any of the named tables."""
    out = None
    for name, t in tables.items():
        hits = failure(t.select(family).distinct().join(ineligible.select(family), family, "left_semi"), "ineligible_ranked", family, F.lit(name))
        out = hits if out is None else out.unionByName(hits)
    return out


def subset(rows: DataFrame, of: DataFrame, keys: list[str], check: str, family: str) -> DataFrame:
    """Rows whose keys the other table lacks: license_queue, alias_target, abstention_leak and known answers are such checks."""
    return failure(rows.join(of.select(*keys).distinct(), keys, "left_anti"), check, family, F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))


def leak(rows: DataFrame, barred: DataFrame, keys: list[str], check: str, family: str) -> DataFrame:
    """Rows that stand in a table they are barred from."""
    return failure(rows.join(barred.select(*keys).distinct(), keys, "left_semi"), check, family, F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))


def rerun_differs(stored: DataFrame, again: DataFrame, keys: list[str], family: str) -> DataFrame:
    """Rows that a second run does not give alike, value by value, either way."""
    rest = [c for c in stored.columns if c not in keys]
    a, b = (t.select(*keys, F.struct(*rest).alias(n)) for t, n in ((stored, "_a"), (again, "_b")))
    both = a.join(b, keys, "full_outer").where(~F.col("_a").eqNullSafe(F.col("_b")))
    return failure(both, "rerun_differs", family, F.when(F.col("_a").isNull(), "new").when(F.col("_b").isNull(), "gone").otherwise("changed"))


def single_source_ranked(terms: DataFrame, ranked: DataFrame, private: str, family: str) -> DataFrame:
    """Ranked families whose only observed term is one private source's."""
    by = terms.where("state = 'observed'").groupBy(family).agg(F.count_distinct("source").alias("_n"), F.max("source").alias("_s"))
    hits = by.where((F.col("_n") == 1) & (F.col("_s") == private)).join(ranked.select(family), family, "left_semi")
    return failure(hits, "fot_only_ranked", family, F.col("_s"))


def views_differ(chosen: DataFrame, installed: DataFrame, linux: list[str], family: str) -> DataFrame:
    """Two views may differ by the chosen one lacking Linux terms alone: what else differs."""
    a = chosen.select("source", family, F.struct("state", "x").alias("_a"))
    b = installed.select("source", family, F.struct("state", "x").alias("_b"))
    both = a.join(b, ["source", family], "full_outer")
    what = F.when(F.col("_b").isNull(), "not installed").when(F.col("_a").isNull() & ~F.col("source").isin(linux), "missing").when(F.col("_a") != F.col("_b"), "other evidence")
    return failure(both.withColumn("_what", what).where("_what is not null"), "desktop_views_differ", family, F.concat_ws(":", "source", "_what"))


#: A number as reports write it: whole or with decimals, with or without commas between thousands.
NUMBER = r"(?<![0-9.,])([0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)(?:\.[0-9]+)?(?![0-9,]|\.[0-9])"


def raw_published(reports: DataFrame, hidden: DataFrame, report: str = "report", text: str = "text") -> DataFrame:
    """Reports that show a value which no output may show, on a line that names its font.

    hidden: value (a number) and label (a name of its font). A number with decimals stands for the whole
    numbers on both sides. Numbers of all reports meet the hidden values by equality, and the labels of
    those alone are looked for in the line.
    """
    lines = reports.select(F.col(report).alias("_report"), F.explode(F.split(F.lower(text), r"\r\n|\r|\n")).alias("_line"))
    number = F.explode(F.array_distinct(F.regexp_extract_all("_line", F.lit(NUMBER), F.lit(0)))).alias("_number")
    shown = lines.select("*", number).withColumn("_number", F.regexp_replace("_number", ",", "").cast("decimal(38,6)"))
    shown = shown.select("_report", "_line", F.explode(F.array_distinct(F.array(F.floor("_number").cast("decimal(38,0)"), F.ceil("_number").cast("decimal(38,0)")))).alias("_whole"))
    value = F.col("value").cast("decimal(38,6)")
    kept = hidden.select(F.explode(F.array_distinct(F.array(F.floor(value).cast("decimal(38,0)"), F.ceil(value).cast("decimal(38,0)")))).alias("_whole"), F.lower("label").alias("_label")).distinct()
    hits = shown.join(kept, "_whole").where(F.col("_line").contains(F.col("_label"))).groupBy("_report").agg(F.count_distinct("_whole").alias("_n"))
    return failure(hits, "raw_value_published", "_report", F.concat_ws(" ", F.col("_n").cast("string"), F.lit("values")))


def share_sums(shares: DataFrame, family: str, source: str, share: str, private: list[str], digits: int = 6) -> DataFrame:
    """Private sources that carry a published share, and families whose known open shares don't sum to 1 within their rounding.

    A share that is null counts for nothing; a family all of whose open shares are null is right.
    """
    known = shares.where(F.col(share).isNotNull())
    closed = F.col(source).isin(list(private))
    by = known.where(~closed).groupBy(family).agg(F.sum(share).alias("_s"), F.count(F.lit(1)).alias("_n"))
    off = by.where(F.abs(F.col("_s") - 1) > F.col("_n") * F.lit(10.0**-digits))
    return failure(known.where(closed), "private_share", family, F.col(source)).unionByName(failure(off, "private_share", family, F.round("_s", digits).cast("string")))


def previous_differs(now: DataFrame, last: DataFrame, changed: DataFrame, keys: list[str], family: str) -> DataFrame:
    """previous has to be the last published score, null for what was not published then.

    It is the own score where nothing at all was published before, and in a rank (keys[0]) whose method changed.
    """
    some = last.select(F.lit(True).alias("_some")).limit(1)  # one row or none
    both = now.join(last.select(*keys, F.col("score").alias("_last")), keys, "left").join(F.broadcast(changed.select(keys[0], F.lit(True).alias("_new")).distinct()), keys[0], "left")
    both = both.join(F.broadcast(some), F.lit(True), "left")
    want = F.when(F.col("_some").isNull() | F.col("_new"), F.col("score")).otherwise(F.col("_last"))
    return failure(both.where(~F.col("previous").eqNullSafe(want)), "previous_score", family, F.coalesce(F.col("previous").cast("string"), F.lit("null")))


def run(checks: dict[str, Callable[[], DataFrame]]) -> DataFrame:
    """All checks' failures as one table."""
    out = None
    for make in checks.values():
        out = make() if out is None else out.unionByName(make())
    return out


# --- flags of a review -----------------------------------------------------------------------------------


def member_flags(before: DataFrame, after: DataFrame, order: DataFrame, family: str) -> DataFrame:
    """Catalog entries and exits with their order; none on a first run."""
    was, now = before.where("member").select(family, F.lit(True).alias("_was")), after.where("member").select(family, F.lit(True).alias("_now"))
    both = was.join(now, family, "full_outer").join(order.select(family, "place"), family, "left")
    some = before.where("member").agg(F.count(F.lit(1)).alias("_n"))
    both = both.join(F.broadcast(some)).where("_n > 0")  # one row
    kind = F.when(F.col("_was").isNull(), "entry").when(F.col("_now").isNull(), "exit")
    return both.select(family, kind.alias("flag"), "place").where("flag is not null")


def changed_flags(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Which of the columns changed for keys of both tables (licence level, text, address)."""
    both = before.select(key, *[F.col(c).alias(f"_{c}") for c in columns]).join(after.select(key, *columns), key)
    moved = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit(c)) for c in columns]))
    return both.select(key, moved.alias("changed")).where(F.size("changed") > 0)


def stale_flags(sources: DataFrame, day: Column, most: int) -> DataFrame:
    """Sources whose newest snapshot is old: stale, or dropped beyond `most` days."""
    age = F.datediff(day, F.col("day"))
    return sources.select("source", age.alias("age"), F.when(age > most, "dropped").when(age > 0, "stale").alias("flag")).where("flag is not null")


def overlap_flags(overlaps: DataFrame, full: int) -> DataFrame:
    """Sources that share fewer families with the ruler than count in full."""
    return overlaps.where(F.col("n") < full).select("source", "n", F.greatest(F.lit(full) - F.col("n"), F.lit(0)).alias("short"))


def guard_flags(guarded: DataFrame, order: DataFrame, family: str, limit: int) -> DataFrame:
    """Guarded terms of the best placed families (`limit` is the report's length)."""
    hits = guarded.where("guard < 1").join(order.select(family, "place"), family)
    return hits.select("source", family, "place").orderBy("place", "source", family).limit(limit)


def growth_flags(now: DataFrame, before: DataFrame, key: str, size: str, share: float = 0.2) -> DataFrame:
    """Sources whose stored size grew by more than a share."""
    both = now.select(key, F.col(size).alias("_now")).join(before.select(key, F.col(size).alias("_was")), key)
    return both.where((F.col("_was") > 0) & (F.col("_now") > (1 + share) * F.col("_was"))).select(key, F.round(F.col("_now") / F.col("_was") - 1, 6).alias("growth"))


def report(flags: DataFrame, group: str, order: list, most: int) -> DataFrame:
    """First `most` flags by group, and behind them how many more there are (n_more)."""
    w = Window.partitionBy(group)
    out = flags.withColumn("n", F.row_number().over(w.orderBy(*order)))
    return out.withColumn("n_more", F.greatest(F.max("n").over(w) - most, F.lit(0))).where(F.col("n") <= most)


def coverage_change(before: DataFrame, now: DataFrame, value: str) -> DataFrame:
    """|n_now - n_before| / n_before of positive values; one row, null without any before."""
    n = lambda df, name: df.agg(F.count_if(F.col(value) > 0).alias(name))
    return n(before, "n_before").join(n(now, "n_now")).select("n_before", "n_now", F.try_divide(F.abs(F.col("n_now") - F.col("n_before")), "n_before").alias("change"))  # one row each
