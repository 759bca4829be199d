"""The fitted measurement model: its functions against brute sums, its fit against simulated truth."""

import math

import numpy as np
import pytest

from plumbline.functions import special as S
from plumbline.operators import measure as M


def test_gamma_beta_and_normal_functions():
    x = np.array([1e-3, 0.3, 1.0, 2.5, 11.9, 12.0, 55.5, 1e6, 1e12])
    assert S.lgamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-13, abs=1e-13)
    d = np.array([0.2, 1.0, 7.0, 40.0])
    h = 1e-5
    assert S.digamma(d) == pytest.approx((S.lgamma(d + h) - S.lgamma(d - h)) / (2 * h), rel=1e-8)
    assert S.betaln(2.5, np.array([3.0, 50.0])) == pytest.approx([math.lgamma(2.5) + math.lgamma(v) - math.lgamma(2.5 + v) for v in (3.0, 50.0)], abs=1e-12)
    # Large arguments: beta(2, b) = 1 / (b (b + 1)).
    assert S.betaln(2.0, 1e12) == pytest.approx(-math.log(1e12) - math.log(1e12 + 1), rel=1e-14)
    z = np.array([-38.0, -8.0, -4.0, -3.9, -1.0, 0.0, 0.5, 3.9, 4.1, 8.0])
    want = [math.log(0.5 * math.erfc(-v / math.sqrt(2))) if v > -37 else -38.0**2 / 2 - math.log(38.0 * math.sqrt(2 * math.pi)) + math.log1p(-1 / 38.0**2) for v in z]
    assert S.log_ndtr(z)[1:] == pytest.approx(want[1:], rel=1e-11, abs=1e-15)
    assert S.log_ndtr(z)[0] == pytest.approx(want[0], rel=1e-5)
    low, high = np.array([-1.0, 6.0, -9.0, 0.5, -1e150]), np.array([1.0, 6.1, -8.9, 0.5 + 1e-9, 0.0])
    got = np.exp(S.log_ndtr_between(low, high))
    assert got[:3] == pytest.approx([math.erf(1 / math.sqrt(2)), 0.5 * (math.erfc(6 / math.sqrt(2)) - math.erfc(6.1 / math.sqrt(2))), 0.5 * (math.erfc(8.9 / math.sqrt(2)) - math.erfc(9 / math.sqrt(2)))], rel=1e-9)
    assert got[3] == pytest.approx(1e-9 * math.exp(-0.125) / math.sqrt(2 * math.pi), rel=1e-5) and got[4] == pytest.approx(0.5)


@pytest.mark.parametrize("k,mean", [(0.4, 3.0), (5.0, 120.0), (900.0, 40.0)])
def test_counts_and_intervals_against_sums(k, mean):
    y = np.arange(0, 4000, dtype=float)
    p = np.exp(M.negbin(y, np.array(mean), k))
    assert p.sum() == pytest.approx(1, abs=1e-9)
    for low, high in ((0, 0), (0, 15), (3, 90), (100, 300)):
        got = M.negbin_between(np.array(float(low)), np.array(float(high)), np.array(mean), k)
        assert float(np.exp(got)) == pytest.approx(p[low : high + 1].sum(), rel=1e-9, abs=1e-12)


def test_moments_of_a_sum_of_log_normals():
    term, own = M.Term("t", dist="lognormal_sum"), np.array([0.7, 0.2, 0.0, math.log(0.8), math.log(0.5)])
    m, s = M.log_moments(term, own, np.array([[2.0]]), np.array([[1.5]]))
    mean = 2.0 * math.exp(0.125) + 1.5 * math.exp(0.32)
    var = 4.0 * math.exp(0.25) * math.expm1(0.25) + 2.25 * math.exp(0.64) * math.expm1(0.64)
    assert float(np.exp(m + s**2 / 2)[0, 0]) == pytest.approx(mean, rel=1e-12)
    assert float((np.exp(s**2) - 1)[0, 0]) == pytest.approx(var / mean**2, rel=1e-12)
    rng = np.random.default_rng(1)
    draws = 2 * np.exp(0.5 * rng.standard_normal(400_000)) + 1.5 * np.exp(0.8 * rng.standard_normal(400_000))
    assert draws.mean() == pytest.approx(mean, rel=0.01)


def test_gradients_against_differences():
    rng, x = np.random.default_rng(3), np.linspace(-3, 3, 7)
    y = np.array([0.0, 3.0, 40.0, 5.0])
    r = M.Rows(y, np.array([0.0, 3.0, 40.0, 9.0]), np.array([[1.0, 0.5]] * 4), np.array([1.0, 2.0, 1.0, 0.5]), np.arange(4))
    exact = M.Rows(y[:3], y[:3], r.n[:3], r.e[:3], np.arange(3))
    own = np.array([-0.5, 0.3, 0.8, -0.2, 0.4])
    term = M.Term("t", ("a", "b"))
    for rows in (exact, r):
        for j, d in enumerate(M.slopes(term, own, rows, x)):
            h = np.eye(5)[j] * 1e-5
            assert d == pytest.approx((M.loglik(term, own + h, rows, x) - M.loglik(term, own - h, rows, x)) / 2e-5, rel=1e-4, abs=1e-6)
    assert rng is not None


def test_climb_stops_at_bounds_and_maxima():
    def value(at, _):
        f = [-((a[0] - 1) ** 2) - 10 * (a[1] - a[0] ** 2) ** 2 for a in at]
        g = [[-2 * (a[0] - 1) + 40 * a[0] * (a[1] - a[0] ** 2), -20 * (a[1] - a[0] ** 2)] for a in at]
        return np.array(f), np.array(g)

    x, f, ok = M.climb(value, np.array([-1.0, 2.0]), np.array([[-5.0, 5.0], [-5.0, 5.0]]))
    assert ok and x == pytest.approx([1, 1], abs=1e-3)
    x, f, ok = M.climb(value, np.array([-1.0, 0.4]), np.array([[-5.0, 5.0], [-5.0, 0.25]]))
    assert ok and x[1] == 0.25


TRUTH = M.Model((M.Term("a"), M.Term("b", dist="lognormal"), M.Term("c"), M.Term("d", dist="lognormal_sum")))
THETA = np.array([0.5, 2.0, 0.1, 1.0, 0.0, 3.0, 0.2, -0.7, 1.0, 1.5, -0.3, 0.5, 1.0, 2.5, 0.0, -0.5, -1.0])


@pytest.fixture(scope="module")
def simulated(spark):
    rng = np.random.default_rng(7)
    fonts = spark.createDataFrame([(k, float(s)) for k, s in enumerate(rng.standard_normal(700))], "id long, score double")
    return fonts.repartition(4), M.simulated(fonts.repartition(4), TRUTH, THETA, seed=11)


@pytest.fixture(scope="module")
def fitted(simulated):
    return M.fit(simulated[1], TRUTH)


def test_fit_recovers_simulated_truth(fitted):
    assert fitted.converged
    free = [i for i in fitted.free if TRUTH.names()[i] not in fitted.at_bound]
    sd = np.sqrt(np.diag(fitted.cov))
    off = np.abs(fitted.theta - THETA)[free] / sd[free]
    assert len(free) >= 12 and (off < 3).all() and (off < 2).mean() >= 0.8
    again = M.Fit.of_record(fitted.record())
    assert (again.theta == fitted.theta).all() and (again.cov == fitted.cov).all() and again.free == fitted.free


def test_gradient_at_the_fit_is_nought(simulated, fitted):
    fonts = M.Fonts.of(simulated[1], TRUTH)
    f, g = fonts.objective([fitted.theta])
    assert f[0] == pytest.approx(fitted.loglik) and np.abs(g[0][list(fitted.free)]).max() < 0.05 * abs(f[0]) ** 0.5
    lower, _ = fonts.objective([fitted.theta + s * np.eye(TRUTH.size)[i] * 0.05 for i in fitted.free for s in (1, -1)], 0)
    assert (lower <= f[0] + 1e-6).all()


def test_calibration_is_uniform_and_conflicts_are_found(spark, simulated, fitted):
    fonts = M.Fonts.of(simulated[1], TRUTH)
    left = M.left_out(fonts, fitted.theta)
    for r in M.calibration(left).collect():
        assert r["fonts"] == 700 and M.ks_probability(r["ks"], 700) > 1e-3 and abs(r["z_sd"] - 1) < 0.12
    odd = simulated[1].selectExpr("id", "term", "case when id = 5 and term = 'a' then 1e7 else y end as y")
    found = M.conflicts(M.left_out(M.Fonts.of(odd, TRUTH), fitted.theta), 1e-5).collect()
    assert {(r["id"], r["term"]) for r in found} >= {(5, "a")} and len(found) < 20


def test_rank_ranges_hold_the_truth(simulated, fitted):
    fonts, counts = simulated
    ranges = {r["id"]: r for r in M.rank_ranges(M.drawn(fitted, M.Fonts.of(counts, TRUTH), 40, 3)).collect()}
    true = {r["id"]: k + 1 for k, r in enumerate(sorted(fonts.collect(), key=lambda r: -r["score"]))}
    inside = sum(ranges[k]["low"] <= true[k] <= ranges[k]["high"] for k in true) / len(true)
    assert 0.83 <= inside <= 0.97


def test_scores_rise_with_counts(simulated, fitted):
    assert {r["term"]: r["falls"] for r in M.falls(fitted, M.Fonts.of(simulated[1], TRUTH), 200).collect() if r["term"] in "ac"} == {"a": 0, "c": 0}


def test_no_bulk_is_held(spark):
    model = M.Model((M.Term("a"), M.Term("b")))
    theta = np.array([-30.0, 3.0, 0.0, 1.0, 0.5, 3.0, 0.0, 1.0])
    fonts = spark.createDataFrame([(k, float(s)) for k, s in enumerate(np.random.default_rng(5).standard_normal(300))], "id long, score double")
    found = M.fit(M.simulated(fonts, model, theta, 1), model)
    assert any(h.startswith("a: log b") for h in found.held) and 0 not in found.free and found.cov[0, 0] == 0


def test_intervals_zeros_nulls_and_no_fonts(spark):
    model = M.Model((M.Term("a"), M.Term("b", dist="lognormal")))
    rows = [("x", "a", 0.0, 15.0), ("x", "b", 0.0, None), ("y", "a", 7.0, None), ("y", "b", None, None), (None, "a", 3.0, None), ("z", "other", 1.0, None)]
    fonts = M.Fonts.of(spark.createDataFrame(rows, "id string, term string, y double, high double"), model)
    got = {r["id"]: [(t["t"], t["y"], t["high"]) for t in r["ts"]] for r in fonts.table.collect()}
    assert got == {"x": [(0, 0.0, 15.0), (1, 0.0, 1.0)], "y": [(0, 7.0, 7.0)], None: [(0, 3.0, 3.0)]}
    theta = np.array([0.0, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0])
    assert M.scores(fonts, theta).count() == 3 and M.left_out(fonts, theta).count() == 4
    none = M.Fonts.of(spark.createDataFrame([], "id string, term string, y double"), model)
    assert M.scores(none, theta).count() == 0 and none.objective([theta])[0].tolist() == [0.0]
