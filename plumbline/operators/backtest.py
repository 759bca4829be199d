"""Backtest of the sources' changes from window to window: whole months, rolling and slid windows, thresholds beyond the worst change seen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.kernel import row_numbers
from plumbline.operators import lists
from plumbline.operators.timeseries import latest_run, month_number
from plumbline.sources.records import written

#: Days that a fixed window is slid by, and by how many the short window that feeds it may differ.
SLIDE, NEAR = 30, 3


def whole_months(rows: DataFrame, source: str, start: str, end: str, month: str, run_day: Column | None = None) -> DataFrame:
    """(source, month) of the months that are whole: the rows together span them, and they ended before run_day."""
    first = F.make_date(F.floor(F.col(month) / 12).cast("int"), (F.col(month) % 12 + 1).cast("int"), F.lit(1))
    spans = rows.groupBy(source, month).agg(F.min(start).alias("_start"), F.max(end).alias("_end"))
    ok = (F.col("_start") <= first) & (F.col("_end") >= F.last_day(first))
    ok = ok & (F.last_day(first) < run_day) if run_day is not None else ok
    return spans.where(ok).select(source, month)


def monthly_windows(values: DataFrame, source: str, item: str, month: str, value: str, months: int) -> DataFrame:
    """(source, first, last, item, value): sums over windows of `months` months, slid by one over each source's latest run of months.

    Where the run isn't longer than that, windows are one month shorter than it; a run of one month has none. A
    row goes to every window that holds its month, `months` at most, and is summed by task before it is shuffled.
    """
    run = latest_run(values, [source], month).withColumn("_length", F.least(F.lit(months), F.col("months") - 1)).where("_length >= 1")
    inside = values.join(F.broadcast(run.select(source, F.col("first").alias("_from"), F.col("last").alias("_to"), "_length")), source)  # a row by source
    inside = inside.where(F.col(month).between(F.col("_from"), F.col("_to")))
    starts = F.sequence(F.greatest(F.col("_from"), F.col(month) - F.col("_length") + 1), F.least(F.col(month), F.col("_to") - F.col("_length") + 1))
    out = inside.select(source, item, value, "_length", F.explode(starts).alias("first"))
    return out.groupBy(source, "first", (F.col("first") + F.col("_length") - 1).alias("last"), item).agg(F.sum(value).alias(value))


def slid_windows(long: DataFrame, short: DataFrame, source: str, item: str, value: str, days: str) -> DataFrame:
    """(source, step, item, value): a fixed long window (step 0), and what it would be SLIDE days on (step 1).

    The long window keeps the share of its days that stays; the short one, scaled to what the long one has in
    SLIDE days, is added. A source whose long window isn't longer than SLIDE days, whose short one is
    not about that, or one of which has no positive value, has no windows.
    """
    whole = lambda df, name: df.groupBy(source).agg(F.sum(F.greatest(F.col(value), F.lit(0))).alias(name), F.max(days).alias(f"{name}_days"))
    both = whole(long, "_long").join(whole(short, "_short"), source)
    both = both.where((F.col("_long_days") > SLIDE) & (F.abs(F.col("_short_days") - SLIDE) <= NEAR) & (F.col("_short_days") < F.col("_long_days")) & (F.col("_long") > 0) & (F.col("_short") > 0))
    both = both.select(source, (1 - SLIDE / F.col("_long_days")).alias("_kept"), (F.col("_long") * SLIDE / F.col("_long_days") / F.col("_short")).alias("_scale"))
    a, b = (df.groupBy(source, item).agg(F.sum(value).alias(n)) for df, n in ((long, "_a"), (short, "_b")))
    rows = a.join(b, [source, item], "full_outer").join(F.broadcast(both), source)  # a row by source
    moved = F.coalesce("_a", F.lit(0.0)) * F.col("_kept") + F.coalesce("_b", F.lit(0.0)) * F.col("_scale")
    return rows.select(source, item, F.inline(F.array(F.struct(F.lit(0).alias("step"), F.col("_a").cast("double").alias(value)), F.struct(F.lit(1).alias("step"), moved.alias(value))))).where(F.col(value).isNotNull())


def pair_statistics(windows: DataFrame, source: str, order: str, item: str, value: str, top: int, least_share: float) -> DataFrame:
    """(source, order, rho, jump, coverage): what changes from each window to the next one of its source.

    rho: rank correlation over the union of both tops (what one lacks counts 0); jump: the largest factor by
    which a share of some size changes; coverage: the relative change of the number of items above 0.
    """
    windows = written(windows.select(source, order, item, value), "windows")
    ranked = row_numbers(windows.where(F.col(value) > 0), [source, order], value, [F.desc(value), item], "_rank", falling=True)
    sums = ranked.groupBy(source, order).agg(F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_n"))
    steps = windows.select(source, order).distinct()
    steps = steps.withColumn("_step", F.row_number().over(Window.partitionBy(source).orderBy(order)))  # a row by window
    ranked = ranked.join(sums, [source, order]).join(steps, [source, order]).withColumn("_share", F.col(value) / F.col("_sum"))
    now = ranked.select(source, F.col("_step").alias("step"), item, F.col(value).alias("a"), F.col("_share").alias("sa"), F.col("_rank").alias("ra"))
    nxt = ranked.select(source, (F.col("_step") - 1).alias("step"), item, F.col(value).alias("b"), F.col("_share").alias("sb"), F.col("_rank").alias("rb"))
    both = now.join(nxt, [source, "step", item], "full_outer")
    pairs = steps.where("_step > 1").select(source, (F.col("_step") - 1).alias("step"))
    both = written(both.join(pairs, [source, "step"], "left_semi"), "window-pairs")
    tops = written(both.where((F.col("ra") <= top) | (F.col("rb") <= top)).select(source, "step", F.coalesce("a", F.lit(0.0)).alias("a"), F.coalesce("b", F.lit(0.0)).alias("b")), "window-tops")
    rho = lists.spearman(tops, [source, "step"], "a", "b").select(source, "step", "rho")
    jump = both.where((F.greatest(F.coalesce("sa", F.lit(0.0)), F.coalesce("sb", F.lit(0.0))) >= least_share) & F.col("sa").isNotNull() & F.col("sb").isNotNull())
    jump = jump.groupBy(source, "step").agg(F.max(F.greatest(F.col("sb") / F.col("sa"), F.col("sa") / F.col("sb"))).alias("jump"))
    counts = both.groupBy(source, "step").agg(F.count("a").alias("_na"), F.count("b").alias("_nb"))
    counts = counts.select(source, "step", F.when(F.col("_na") > 0, F.abs(F.col("_nb") - F.col("_na")) / F.col("_na")).alias("coverage"))
    return pairs.join(rho, [source, "step"], "left").join(jump, [source, "step"], "left").join(counts, [source, "step"], "left")


def suggested(pairs: DataFrame, margin: float = 0.02, places: int = 2) -> DataFrame:
    """(threshold, value): the worst of each statistic, moved out by the margin and rounded outwards; what was never measured has no row."""
    scale = float(10**places)
    down = lambda c: F.floor(F.round((c - margin) * scale, 6)) / scale
    up = lambda c: F.ceil(F.round((c + margin) * scale, 6)) / scale
    worst = pairs.agg(down(F.min("rho")).alias("spearman_min"), up(F.max("jump")).alias("share_jump_max"), up(F.max("coverage")).alias("coverage_change_max"))
    return worst.select(F.inline(F.array(*[F.struct(F.lit(c).alias("threshold"), F.col(c).cast("double").alias("value")) for c in worst.columns]))).where("value is not null")


def backtest(rows: DataFrame, source: str, item: str, value: str, start: str, end: str, months: int, top: int, least_share: float, run_day: Column | None = None) -> DataFrame:
    """Statistics of all window pairs of sources with monthly rows (source, item, value, start, end)."""
    monthly = rows.withColumn("_month", month_number(F.col(start)))
    whole = whole_months(monthly, source, start, end, "_month", run_day)
    kept = monthly.join(F.broadcast(whole), [source, "_month"])  # a row by source and month
    windows = monthly_windows(kept.groupBy(source, "_month", item).agg(F.sum(value).alias(value)), source, item, "_month", value, months)
    return pair_statistics(windows, source, "first", item, value, top, least_share)
