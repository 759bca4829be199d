"""Longitudinal operators: smoothing, histories, rising, membership with hysteresis, islands, rolling sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def smoothed(now: DataFrame, state: DataFrame, keys: list[str], z: str, lam: float) -> DataFrame:
    """Exponentially weighted mean of observed values with the state of the month before; new keys start at their value."""
    prev = state.select(*keys, F.col(z).alias("_prev"))
    return now.join(prev, keys, "left").withColumn("smooth", lam * F.col(z) + (1 - lam) * F.coalesce("_prev", z)).drop("_prev")


def history(prev: DataFrame, now: DataFrame, source: str, key: str, share: str, keep: int, empty: bool = False) -> DataFrame:
    """Histories (arrays, oldest first) with this period's share at their end; the last `keep` stay, all-zero ones go unless `empty` ones are kept.

    A new key starts with this period alone; a key that its source no longer shows gets 0; a source
    without any data this period keeps its histories as they are.
    """
    seen = now.select(source).distinct().withColumn("_seen", F.lit(True))
    both = prev.select(source, key, "history").join(now.select(source, key, F.col(share).cast("double").alias("_now")), [source, key], "full_outer")
    both = both.join(seen, source, "left")
    new = F.concat(F.coalesce("history", F.array().cast("array<double>")), F.array(F.coalesce("_now", F.lit(0.0))))
    new = F.slice(new, F.greatest(F.size(new) - keep + 1, F.lit(1)), keep)
    out = both.select(source, key, F.col("_seen").isNull().alias("_old"), F.when(F.col("_seen"), new).otherwise(F.col("history")).alias("history"))
    return out.where(F.col("_old") | F.lit(empty) | F.exists("history", lambda x: x > 0)).drop("_old")


def histories(shares: DataFrame, source: str, key: str, period: str, share: str, keep: int) -> DataFrame:
    """Histories of whole period numbers at once: from a key's first period to its source's last, missing ones 0, the last `keep`."""
    last = shares.groupBy(source).agg(F.max(period).alias("_last"))
    by = shares.groupBy(source, key).agg(F.map_from_entries(F.collect_list(F.struct(F.col(period).cast("long"), F.col(share)))).alias("_m"), F.min(period).cast("long").alias("_first"))
    by = by.join(last, source).withColumn("_from", F.greatest("_first", (F.col("_last") - keep + 1).cast("long")))
    return by.select(source, key, F.transform(F.sequence("_from", F.col("_last").cast("long")), lambda m: F.coalesce(F.element_at("_m", m), F.lit(0.0))).alias("history"))


def rising(histories: DataFrame, keys: list[str], recent: int = 3, months: int = 3, least: float = 0.0002, base: str | None = None) -> DataFrame:
    """Log-ratio of the mean of the last `recent` shares to `base` (else to the history's mean), for shares of some size."""
    mean = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / F.size(a)
    own = F.slice("history", F.greatest(F.size("history") - recent + 1, F.lit(1)), recent)
    some = histories.where(F.size("history") >= max(1, months)).withColumn("_recent", mean(own)).withColumn("_base", F.col(base) if base else mean(F.col("history")))
    return some.where((F.col("_recent") >= least) & (F.col("_recent") > 0) & (F.col("_base") > 0)).select(*keys, F.log(F.col("_recent") / F.col("_base")).alias("ratio"))


def agreed(ratios: DataFrame, family: str, ratio: str, need: int) -> DataFrame:
    """The need-th largest positive ratio among a family's sources."""
    w = Window.partitionBy(family).orderBy(F.desc(ratio))
    return ratios.where(F.col(ratio) > 1e-9).withColumn("_n", F.row_number().over(w)).where(F.col("_n") == need).drop("_n")


STATE = ["member", "entered", "runs_outside"]


def hysteresis(orders: DataFrame, state: DataFrame, parts: list[str], key: str, enter: int, leave: int, runs: int, first: int, day: Column, kept: DataFrame | None = None) -> DataFrame:
    """Each list's next states from orders (parts, key, place) and state (parts, key, member, entered, runs_outside).

    A member stays while at `leave` or better; each run outside adds one, and at `runs` it leaves: it
    is then there for this one run with member false. Others come in at `enter` or better, with `day` as
    entered; a list without members takes the first `first`. What `kept` (parts, key) names stays or comes in.
    """
    keys = [*parts, key]
    old = state.select(*keys, F.col("member").alias("_was"), F.col("entered").alias("_entered"), F.col("runs_outside").alias("_runs"))
    full = state.where("member").select(*parts, F.lit(True).alias("_some")).distinct()
    both = orders.select(*keys, "place").join(old, keys, "full_outer")
    if kept is not None:
        both = both.join(kept.select(*keys, F.lit(True).alias("_kept")).distinct(), keys, "full_outer")
    both = both.join(full, parts, "left") if parts else both.join(F.broadcast(state.agg(F.max("member").alias("_some"))))  # one row
    held = F.coalesce(F.col("_kept"), F.lit(False)) if kept is not None else F.lit(False)
    at = lambda n: F.coalesce(F.col("place") <= n, F.lit(False))
    was, inside = F.coalesce("_was", F.lit(False)), at(leave) | held
    comes = F.when(F.coalesce("_some", F.lit(False)), at(enter)).otherwise(at(first)) | held
    outside = F.when(was & ~inside, F.col("_runs") + 1).otherwise(0).cast("int")
    member = F.when(was, inside | (outside < runs)).otherwise(comes)
    out = both.select(*keys, member.alias("member"), F.when(was, F.col("_entered")).otherwise(day).alias("entered"), outside.alias("runs_outside"), was.alias("_was"))
    return out.where(F.col("_was") | F.col("member")).drop("_was")


def membership(orders: DataFrame, lists: DataFrame, catalog: DataFrame, key: str, whole: str, extra: list[str], day: Column, top: tuple[int, int, int, int], all_: tuple[int, int, int, int]) -> tuple[DataFrame, DataFrame]:
    """Next states of every list (list, key) and of the catalog (key).

    top and all_: enter, leave, runs, first. The catalog follows the list `whole`, and keeps and admits
    every member of the lists in `extra`.
    """
    tops = hysteresis(orders, lists, ["list"], key, *top, day)
    kept = tops.where(F.col("list").isin(extra) & F.col("member")).select(key)
    return tops, hysteresis(orders.where(F.col("list") == whole).select(key, "place"), catalog, [], key, *all_, day, kept)


def excluded(states: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """States with what is excluded out at once; excluded ones that were no members are dropped."""
    out = states.join(gone.select(key, F.lit(True).alias("_gone")).distinct(), key, "left")
    return out.where(F.col("member") | F.col("_gone").isNull()).withColumn("member", F.col("member") & F.col("_gone").isNull()).drop("_gone")


def first_seen(prev: DataFrame, now: DataFrame, keys: list[str], day: str) -> DataFrame:
    """First days merged: the earlier one wins."""
    both = prev.select(*keys, F.col(day).alias("_old")).join(now.select(*keys, F.col(day).alias("_new")), keys, "full_outer")
    return both.select(*keys, F.least("_old", "_new").alias(day))


def month_number(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def rolling(df: DataFrame, keys: list[str], month: str, value: str, periods: int) -> DataFrame:
    """Sums over the last periods of consecutive month numbers, for months with data."""
    w = Window.partitionBy(*keys).orderBy(month).rangeBetween(1 - periods, 0)
    return df.withColumn("rolled", F.sum(value).over(w)).withColumn("periods", F.count(F.lit(1)).over(w))


def latest_run(df: DataFrame, keys: list[str], month: str) -> DataFrame:
    """Newest run of consecutive months of each key."""
    w = Window.partitionBy(*keys).orderBy(month)
    isles = df.select(*keys, month).distinct().withColumn("_isle", F.col(month) - F.row_number().over(w))
    runs = isles.groupBy(*keys, "_isle").agg(F.min(month).alias("first"), F.max(month).alias("last"), F.count(F.lit(1)).alias("months"))
    return runs.groupBy(*keys).agg(F.max_by(F.struct("first", "last", "months"), "last").alias("_r")).select(*keys, "_r.first", "_r.last", "_r.months")


def as_of(requests: DataFrame, snapshots: DataFrame, by: list[str], day: str, snapshot_day: str, max_age: int) -> DataFrame:
    """Newest snapshot not after each request's day and not older than max_age days.

    Both sides are merged and the last snapshot is carried forward, so no pair of a request and a
    snapshot other than the wanted one is ever made.
    """
    a = requests.select(*by, F.col(day).alias("_day"), F.lit(1).alias("_kind"), F.lit(None).cast("date").alias("_snap"))
    b = snapshots.select(*by, F.col(snapshot_day).alias("_day"), F.lit(0).alias("_kind"), F.col(snapshot_day).alias("_snap"))
    w = Window.partitionBy(*by).orderBy("_day", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = a.unionByName(b).withColumn("_last", F.last("_snap", ignorenulls=True).over(w)).where("_kind = 1")
    return out.select(*by, F.col("_day").alias(day), F.when(F.datediff("_day", "_last") <= max_age, F.col("_last")).alias("snapshot"))
