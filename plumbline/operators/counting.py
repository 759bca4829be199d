"""From observations to one count per key: windows, pooled shares, snapshot growth, weekly means, floors, credits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def snapped_days(days: Column) -> Column:
    """Length of a window: about a year counts as 365 days, about a month as a twelfth of that."""
    return F.when(days.between(358, 372), F.lit(365.0)).when(days.between(28, 31), F.lit(365.0 / 12)).otherwise(days.cast("double"))


def count_window(obs: DataFrame, keys: list[str], value: str, day: str) -> DataFrame:
    """Total by key, and per year over the window that the key's observations span."""
    out = obs.groupBy(*keys).agg(F.sum(value).alias("total"), F.min(day).alias("start"), F.max(day).alias("end"))
    days = F.datediff("end", "start") + 1
    return out.withColumn("days", days).withColumn("per_year", F.col("total") * 365.0 / snapped_days(F.col("days")))


def pooled_share(obs: DataFrame, key: str, series: str, value: str, periods: int, samples: str | None = None, unit: str | None = None) -> DataFrame:
    """A key's total over the last periods by the sample of all these periods, present in them or not.

    samples: column with the period's sample (one number by period; 1 where nobody gives it), else the
    period's own total. Rows whose `unit` is 'share' count as that share of the sample. A key without
    installs has the share 0, one without any value none. start: its first period with installs, null
    if that is the first of all.
    """
    size = F.coalesce(F.max(samples).cast("double"), F.lit(1.0)) if samples else F.sum(value)
    sample = obs.groupBy(series).agg(size.alias("_sample"))
    recent = sample.orderBy(F.desc(series)).limit(periods)  # a handful of periods
    inside = obs.join(F.broadcast(recent), series)
    count = F.when(F.col(unit) == "share", F.col(value) * F.col("_sample")).otherwise(F.col(value)) if unit else F.col(value)
    whole = recent.agg(F.sum("_sample").alias("samples"), F.min(series).alias("_first"))
    by_key = inside.groupBy(key).agg(F.sum(count).alias("installs"), F.min(F.when(F.col(value) > 0, F.col(series))).alias("_begin"))
    out = by_key.join(F.broadcast(whole))  # one row
    share = F.when(F.col("_begin").isNotNull() & (F.col("samples") > 0), F.col("installs") / F.col("samples")).when(F.col("installs").isNotNull(), 0.0)
    return out.select(key, "installs", "samples", share.alias("share"), F.when(F.col("_begin") > F.col("_first"), F.col("_begin")).alias("start"))


def snapshot_growth(now: DataFrame, baseline: DataFrame, keys: list[str], value: str, created: str, end: str, per: float = 365.0) -> DataFrame:
    """Growth of each asset since the baseline, scaled to `per` days.

    An asset of both counts its growth (shrinkage is none) over the days between its two data days; one
    created after the baseline's last day counts whole over the days since then; an older one that the
    baseline lacks does not count. An empty baseline gives no growth at all.
    """
    base = baseline.select(*keys, F.col(value).alias("_base"), F.col(end).alias("_day"))
    since = base.agg(F.max("_day").alias("_since"))  # one row
    days = lambda a: F.greatest(F.datediff(F.col(end), F.col(a)), F.lit(1))
    grown = F.when(F.col("_base").isNotNull(), F.greatest(F.col(value) - F.col("_base"), F.lit(0)) * per / days("_day"))
    grown = grown.when(F.col(created) > F.col("_since"), F.col(value) * per / days("_since"))
    return now.join(base, keys, "left").join(F.broadcast(since)).withColumn("growth", grown).drop("_base", "_day", "_since")


def weekly_mean(obs: DataFrame, key: str, week: str, value: str, end: str, days: int = 31) -> DataFrame:
    """Mean over the weeks that end within the last `days` of the data, weeks without the key counting as nothing."""
    ends = obs.groupBy(week).agg(F.max(end).alias("_end"))  # one row by week
    last = ends.agg(F.max("_end").alias("_last"))
    month = ends.join(F.broadcast(last)).where(F.col("_end") > F.date_sub("_last", days)).select(week)
    n = month.agg(F.count(F.lit(1)).alias("weeks"))
    inside = obs.join(F.broadcast(month), week)
    return inside.groupBy(key).agg(F.sum(value).alias("total")).join(F.broadcast(n)).select(key, "total", "weeks", (F.col("total") / F.col("weeks")).alias("mean"))


def capped_share(obs: DataFrame, period: str, category: str, capped: str, value: str, cap: float) -> DataFrame:
    """Factors by which one category gets at most the share `cap` of its period, the period keeping its whole.

    A period without that category, or with nothing else, is left as it is.
    """
    sums = obs.groupBy(period).agg(F.sum(F.when(F.col(category) == capped, F.col(value)).otherwise(0)).alias("_s"), F.sum(value).alias("_n"))
    over = (F.col("_s") > 0) & (F.col("_s") < F.col("_n")) & (F.col("_s") > cap * F.col("_n"))
    factor = F.when(~over, 1.0).when(F.col(category) == capped, cap * F.col("_n") / F.col("_s")).otherwise((1 - cap) * F.col("_n") / (F.col("_n") - F.col("_s")))
    return obs.join(sums, period).withColumn("factor", factor).drop("_s", "_n")


def largest_of_case(df: DataFrame, fold: Column, key: str, value: str) -> DataFrame:
    """One row for keys that differ in case alone: the one of most value, the smallest key among equals."""
    turn = Window.partitionBy("_fold").orderBy(F.desc(value), key)
    return df.withColumn("_fold", fold).withColumn("_turn", F.row_number().over(turn)).where("_turn = 1").drop("_turn").withColumnRenamed("_fold", "fold")


def family_sums(links: DataFrame, family: str, key: str, value: str, credit: str, bundled: str) -> DataFrame:
    """By family: the credited sum, the largest single value, and whether every part came in a bundle.

    Each key counts once (of repeated links the least one); a family whose keys all lack a value has none.
    """
    rest = [c for c in links.columns if c not in (family, key)]
    once = links.groupBy(family, key).agg(F.min(F.struct(*rest)).alias("_l")).select(family, key, "_l.*")
    return once.groupBy(family).agg(F.sum(F.col(value) * F.col(credit)).alias("credited"), F.max(value).alias("largest"), F.count(F.lit(1)).alias("n_keys"), F.every(F.col(bundled)).alias("bundle_only"))


def key_floor(df: DataFrame, group: str, value: str, q: float) -> DataFrame:
    """Values less the q quantile of their group's positive values, not below 0."""
    floors = df.where(F.col(value) > 0).groupBy(group).agg(F.percentile(value, q).alias("floor"))
    return df.join(floors, group, "left").withColumn("above", F.greatest(F.col(value) - F.coalesce("floor", F.lit(0.0)), F.lit(0.0)))


def shared_floor(df: DataFrame, owner: str, turn: str, value: str, floor: float) -> DataFrame:
    """Each owner loses the floor once, from its keys in the order of turn."""
    before = Window.partitionBy(owner).orderBy(turn).rowsBetween(Window.unboundedPreceding, -1)
    left = F.greatest(F.lit(floor) - F.coalesce(F.sum(value).over(before), F.lit(0.0)), F.lit(0.0))
    return df.withColumn("above", F.col(value) - F.least(left, F.col(value)))


def floored(df: DataFrame, value: str, floor: float, censor_below: float) -> DataFrame:
    """Value less a flat floor: observed from censor_below on, else censored at what is left."""
    v = F.col(value) - floor
    seen = (v > 0) & (v >= censor_below)
    return df.withColumn("state", F.when(seen, "observed").otherwise("censored")).withColumn("term", F.when(seen, v).otherwise(F.greatest(v, F.lit(0.0))))


def evidence_state(in_frame: Column, exposed: Column, value: Column, censor_below: float) -> Column:
    """What a source says about a family, by the first rule that holds."""
    return (
        F.when(~in_frame, "not_covered")
        .when(~exposed, "too_new")
        .when(value.isNull(), "censored:no_value")
        .when(value < censor_below, "censored:below_floor")
        .otherwise("observed")
    )


def exposed(first_seen: Column, data_day: Column, days: int) -> Column:
    return first_seen.isNull() | (F.datediff(data_day, first_seen) >= days)


def shares(df: DataFrame, parts: list[str], value: str, zeros: bool = False) -> DataFrame:
    """Positive values by their part's total; with `zeros`, all values, in a part without any total 0."""
    some = df if zeros else df.where(F.col(value) > 0)
    totals = some.groupBy(*parts).agg(F.sum(value).alias("_total"))
    share = F.when(F.col("_total") != 0, F.col(value) / F.col("_total")).otherwise(0.0) if zeros else F.col(value) / F.col("_total")
    return some.join(totals, parts).withColumn("share", share).drop("_total")
