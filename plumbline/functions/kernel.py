"""Statistics kernel as column expressions and window plans: ranks, probit, Hazen quantiles, prefix sums."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Coefficients of algorithm AS 241 (PPND16), numerators and denominators by region.
CENTRAL = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3, 2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3),
)
NEAR_TAIL = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1, 1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
FAR_TAIL = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2, 7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)


def _poly(coefficients: tuple[float, ...], x: Column) -> Column:
    out = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = out * x + F.lit(c)
    return out


def once(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x), where x is worked out once however often f names it: inside lambdas Spark would do so at each place."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def probit(p: Column) -> Column:
    """Inverse of the standard normal distribution function on (0, 1), null elsewhere; no Python."""
    q = p - 0.5
    r0 = F.lit(0.180625) - q * q
    r = F.sqrt(-F.log(F.least(p, 1 - p)))
    tail = F.when(r <= 5, _poly(NEAR_TAIL[0], r - 1.6) / _poly(NEAR_TAIL[1], r - 1.6)).otherwise(_poly(FAR_TAIL[0], r - 5) / _poly(FAR_TAIL[1], r - 5))
    inner = F.when(F.abs(q) <= 0.425, q * _poly(CENTRAL[0], r0) / _poly(CENTRAL[1], r0)).otherwise(F.signum(q) * tail)
    return F.when((p > 0) & (p < 1), inner)


def stretch(x: Column, fine: int = 1024) -> Column:
    """A number that goes up with x: which `fine`-th of an octave x lies in, by sign.

    It needs no look at the data, so an order can be cut into stretches without a job. A stretch spans
    less than 0.1 % of a value; null counts as the least value, infinite ones keep their ends.
    """
    x = x.cast("double")
    size = F.floor(F.greatest(F.least(F.log2(F.abs(x)), F.lit(1100.0)), F.lit(-1100.0)) * fine) + 1200 * fine
    return F.coalesce(F.when(x > 0, size).when(x < 0, -size).otherwise(F.when(x == 0, 0)), F.lit(-4000 * fine)).cast("long")


def running(df: DataFrame, parts: list[str], by: str, order: list, sums: dict[str, Column], falling: bool = False, least: dict[str, Column] | None = None) -> DataFrame:
    """df with sums (and least values) over the rows up to and with its own, in an order that starts with the numeric column `by`.

    The order is cut into stretches of `by` that are summed each for itself; the totals of the
    stretches, a bounded table, are summed over. So a part of any size is spread over tasks, and only
    rows of all but equal `by` meet in one. `falling`: the order starts with `by` descending.
    """
    at = stretch(F.col(by))
    cut = df.withColumn("_stretch", -at if falling else at)
    inside = Window.partitionBy(*parts, "_stretch").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = Window.partitionBy(*[F.col(c) for c in parts] or [F.lit(0)]).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    plan = [(n, c, F.sum, zero, lambda x, y: x + y) for n, c in sums.items()] + [(n, c, F.min, lambda c: c, F.least) for n, c in (least or {}).items()]
    totals = cut.groupBy(*parts, "_stretch").agg(*[f(c).alias(f"_t_{n}") for n, c, f, _, _ in plan])
    bases = totals.select(*parts, "_stretch", *[fill(f(f"_t_{n}").over(upto)).alias(f"_b_{n}") for n, _, f, fill, _ in plan])
    out = cut.withColumns({f"_i_{n}": fill(f(c).over(inside)) for n, c, f, fill, _ in plan}).join(bases, [*parts, "_stretch"])
    return out.withColumns({n: both(F.col(f"_b_{n}"), F.col(f"_i_{n}")) for n, _, _, _, both in plan}).drop("_stretch", *[f"_{k}_{n}" for k in "bi" for n, *_ in plan])


def row_numbers(df: DataFrame, parts: list[str], by: str, order: list, out: str = "place", falling: bool = False) -> DataFrame:
    """df with each row's place in its part, from 1; see running()."""
    return running(df, parts, by, order, {out: F.lit(1)}, falling)


def prefix_counts(values: DataFrame, parts: list[str], order: str, weight: str) -> DataFrame:
    """values with `before` and `total`: sums of weight over smaller values of order, and over all, by part.

    One row per part and value is expected; a part of any size is spread over tasks.
    """
    totals = values.groupBy(*parts).agg(F.sum(weight).alias("total"))
    out = running(values, parts, order, [order], {"before": F.col(weight)})
    return out.withColumn("before", F.col("before") - F.col(weight)).join(totals, parts)


def tie_blocks(df: DataFrame, parts: list[str], value: str) -> DataFrame:
    """By part and distinct value: lower (how many are smaller), here (how many equal it), n (how many in all)."""
    counted = df.groupBy(*parts, value).agg(F.count(F.lit(1)).alias("here"))
    return prefix_counts(counted, parts, value, "here").select(*parts, value, F.col("before").alias("lower"), "here", F.col("total").alias("n"))


def midrank(lower: Column, here: Column, n: Column) -> Column:
    """Mid-rank percentile of a tie block."""
    return (lower + lower + here) / (2 * n)


def with_midrank(df: DataFrame, parts: list[str], value: str, out: str = "p") -> DataFrame:
    blocks = tie_blocks(df, parts, value).withColumn(out, midrank(F.col("lower"), F.col("here"), F.col("n")))
    return df.join(blocks.select(*parts, value, out), [*parts, value])


def hazen_position(p: Column, n: Column) -> Column:
    """Place of the p quantile among n sorted values (from 1): halves are snapped to, ends are clamped."""
    h = n * p + 0.5
    half = F.round(h * 2) / 2
    return F.least(F.greatest(F.when(F.abs(h - half) < 1e-9, half).otherwise(h), F.lit(1.0)), n.cast("double"))


def significant(x: Column, digits: int = 9) -> Column:
    """x rounded to a number of significant digits."""
    scale = F.pow(F.lit(10.0), F.lit(digits - 1) - F.floor(F.log10(F.abs(x))))
    return F.when(x == 0, F.lit(0.0)).otherwise(F.round(x * scale) / scale)


def six(x: Column) -> Column:
    """x with 6 decimals; no negative zero."""
    return F.round(x, 6) + F.lit(0.0)
