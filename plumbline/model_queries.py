"""Queries of the fitted measurement model, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from plumbline.operators import measure, model
from plumbline.plans.views import observations, sql
from plumbline.queries import query
from plumbline.session import table

#: Parameters of the example's five terms, each with one baseline: log b, alpha, log lambda, log k.
GIVEN = {"click": (-1.6, 1.0, -0.2, 1.1), "error": (-2.3, 0.4, -0.5, 0.9), "purchase": (-2.3, 0.5, -0.1, 0.7), "signup": (-1.9, 0.3, -0.3, 1.0), "view": (-2.3, 1.2, -0.5, 1.4)}
MODEL = measure.Model(tuple(measure.Term(t) for t in GIVEN))
THETA = np.array([v for g in GIVEN.values() for v in g])


def _counts(spark, d):
    """Events by user (font) and type (term)."""
    return observations(spark, d).groupBy(F.col("family").alias("id"), F.col("source").alias("term")).agg(F.count(F.lit(1)).alias("y"))


@query()
def model_fit(spark, d):
    """Every parameter of the five terms with its standard error, and whether the search reached a maximum."""
    found = measure.fit(_counts(spark, d), MODEL, rounds=40)
    rows = [(*r, found.converged, found.loglik) for r in found.rows()]
    return spark.createDataFrame(rows, "parameter string, estimate double, standard_error double, state string, converged boolean, loglik double")


_G = {c: "case source " + " ".join(f"when '{t}' then {g[k]}" for t, g in GIVEN.items()) + " end" for k, c in enumerate(("lb", "alpha", "ll", "lk"))}
_NODES = f"select i, {model.LOW} + {model.STEP} * i x, ln({model.STEP} * case when i in (0, 260) then 0.5 else 1.0 end) - ({model.LOW} + {model.STEP} * i) ** 2 / 2 - 0.5 * ln(2 * pi()) w from range(261) t(i)"
#: The model by hand: log-probabilities by font, term and node, and the sums of a font.
_PARTS = f""", t as (select family, source, count(*)::double y, {", ".join(f"({v})::double {c}" for c, v in _G.items())} from obs group by all), g as ({_NODES}),
 c as (select family, source, y, i, x, w, exp(lb) + exp(alpha + exp(ll) * x) m, exp(lk) k from t, g), e as (select *, lgamma(y + k) - lgamma(k) - lgamma(y + 1) + k * ln(k / (k + m)) + y * ln(m / (k + m)) l from c),
 f as (select family, i, any_value(w) + sum(l) total from e group by all)"""
_LEFT = _PARTS + """, own as (select e.*, exp(total - l - max(total - l) over (partition by e.family, source)) p from e join f on e.family = f.family and e.i = f.i),
 cum as (select family, source, i, sum(case when j < y then exp(lgamma(j + k) - lgamma(k) - lgamma(j + 1) + k * ln(k / (k + m)) + j * ln(m / (k + m))) else 0 end) below, any_value(exp(l)) here, any_value(p) p
  from own, (select unnest(range((select max(y)::bigint + 1 from t)))::double j) where j <= y group by family, source, i),
 lo as (select family, source, sum(p * below) / sum(p) low, sum(p * (below + here)) / sum(p) high from cum group by all)"""


@query(sql(_LEFT + " select family id, source as term, round(low, 5) low, round(high, 5) high from lo", "obs"))
def model_left_out(spark, d):
    """Each count's predictive interval under its font's other terms."""
    left = measure.left_out(measure.Fonts.of(_counts(spark, d), MODEL), THETA)
    return left.select("id", "term", *[(F.round(c, 5) + F.lit(0.0)).alias(c) for c in ("low", "high")])


@query(sql(_LEFT + " select family id, source as term from lo where high < 0.1 or low > 0.9", "obs"))
def model_conflicts(spark, d):
    """Fonts of which one source contradicts all others."""
    return measure.conflicts(measure.left_out(measure.Fonts.of(_counts(spark, d), MODEL), THETA), 0.1).select("id", "term")


@query()
def model_calibration(spark, d):
    return measure.calibration(measure.left_out(measure.Fonts.of(_counts(spark, d), MODEL), THETA))


@query(sql(_PARTS + """, b as (select family, i, exp(total - max(total) over (partition by family)) p, max(total) over (partition by family) top from f)
 select family id, round(sum(p * x) / sum(p), 5) mean, round(sqrt(sum(p * x * x) / sum(p) - (sum(p * x) / sum(p)) ** 2), 5) sd, round(any_value(top) + ln(sum(p)), 5) evidence from b join g using (i) group by 1""", "obs"))
def model_scores(spark, d):
    """Scores of all fonts from all five terms."""
    found = measure.scores(measure.Fonts.of(_counts(spark, d), MODEL), THETA)
    return found.select("id", *[(F.round(c, 5) + F.lit(0.0)).alias(c) for c in ("mean", "sd", "evidence")])


@query()
def model_rank_ranges(spark, d):
    """Ranks that hold in nine of ten joint draws, at the given parameters with a tenth of uncertainty each."""
    fit = measure.Fit(MODEL, THETA, 0.0, np.eye(MODEL.size) * 0.01, True, tuple(range(MODEL.size)))
    return measure.rank_ranges(measure.drawn(fit, measure.Fonts.of(_counts(spark, d), MODEL), 50))


@query()
def model_scan(spark, d):
    fit = measure.Fit(MODEL, THETA, 0.0, np.zeros((MODEL.size, MODEL.size)), True, ())
    return measure.falls(fit, measure.Fonts.of(_counts(spark, d), MODEL))


@query("""with s as (select s_suppkey, abs(s_acctbal) b, exp(s_nationkey / 5.0) p, 0.2 + s_suppkey % 5 / 10.0 tau, 0.5 + s_suppkey % 3 / 4.0 sigma from supplier),
 l as (select *, ln(greatest(b, 1e-300)) + tau * tau / 2 lb, ln(greatest(p, 1e-300)) + sigma * sigma / 2 lp from s), m as (select *, greatest(lb, lp) + ln(1 + exp(-abs(lb - lp))) lm from l),
 v as (select *, ln(1 + exp(2 * (lb - lm)) * (exp(tau * tau) - 1) + exp(2 * (lp - lm)) * (exp(sigma * sigma) - 1)) s2 from m)
 select s_suppkey, round(lm - s2 / 2, 6) mean, round(sqrt(s2), 6) sd from v""")
def model_sum_moments(spark, d):
    """Moments of sums of two log-normals: a supplier's balance as bulk, its nation as popularity."""
    s, k = table(spark, d, "supplier"), F.col("s_suppkey")
    m, sd = model.log_sum_moments(F.abs("s_acctbal"), F.exp(F.col("s_nationkey") / 5.0), 0.2 + k % 5 / 10.0, 0.5 + k % 3 / 4.0)
    return s.select("s_suppkey", F.round(m, 6).alias("mean"), F.round(sd, 6).alias("sd"))


@query("""with n as (select o_custkey, count(*) n, round(sum(o_totalprice) / 1e5)::bigint s from orders group by 1), c as (select o_custkey, n lo, n + s hi, s + 0.5 mean, 0.5 + n % 4 k from n)
 select o_custkey, round(ln(greatest(sum(exp(lgamma(j + k) - lgamma(k) - lgamma(j + 1) + k * ln(k / (k + mean)) + j * ln(mean / (k + mean)))), 1e-300)), 6) logp
 from c, (select unnest(range((select max(hi) + 1 from c))) j) where j between lo and hi group by 1""")
def model_count_intervals(spark, d):
    """Log-probability that a count lies between a customer's orders and that plus their total, against sums over all counts."""
    n = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice") / 1e5).cast("long").alias("s"))

    def rows(batches):
        for b in batches:
            n, s = (b.column(c).to_numpy().astype(float) for c in ("n", "s"))
            yield pa.RecordBatch.from_arrays([b.column("o_custkey"), pa.array(measure.negbin_between(n, n + s, s + 0.5, 0.5 + n % 4))], ["o_custkey", "logp"])

    return n.mapInArrow(rows, "o_custkey long, logp double").select("o_custkey", F.round("logp", 6).alias("logp"))


@query("""with p as (select p_partkey, p_size y, p_size * 1.5 + 1 hi, ln(p_retailprice / 40.0) m, 0.3 + p_size % 7 / 5.0 s from part), z as (select p_partkey, (ln(y) - m) / s a, (ln(hi) - m) / s b from p)
 select p_partkey, round(ln(sum((b - a) / 2000 * case when i in (0, 2000) then 1 when i % 2 = 1 then 4 else 2 end / 3 * exp(-0.5 * (a + (b - a) * i / 2000) ** 2) / sqrt(2 * pi()))), 6) logp from z, range(2001) t(i) group by 1""")
def model_value_intervals(spark, d):
    """Log-probability that a log-normal value lies between a part's size and half as much again, against Simpson's rule."""

    def rows(batches):
        for b in batches:
            y, price = (b.column(c).to_numpy().astype(float)[:, None] for c in ("p_size", "p_retailprice"))
            found = measure.lognormal(y, y * 1.5 + 1, np.log(price / 40), 0.3 + y % 7 / 5)
            yield pa.RecordBatch.from_arrays([b.column("p_partkey"), pa.array(found[:, 0])], ["p_partkey", "logp"])

    return table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice").mapInArrow(rows, "p_partkey long, logp double").select("p_partkey", F.round("logp", 6).alias("logp"))
