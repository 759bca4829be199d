"""The measurement model fitted as a whole: terms of three kinds on one latent score, by marginal maximum likelihood.

A term expects e * (sum over groups of n * b + exp(alpha + exp(log lambda) * score)) of a font. Counts
are negative binomial, exact or known to lie in an interval; large values are log-normal, or the sum
of a log-normal bulk and a log-normal popularity. Every font's terms stand in one row (as many as
there are terms); likelihoods are integrated over a fixed grid in numpy, a batch of fonts at a time.
A likelihood with its gradient, at any number of parameter vectors, is one aggregate over the fonts,
so the driver sees a few numbers for each vector and never a font.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.kernel import probit, row_numbers, tie_blocks
from plumbline.functions.special import HALF_LOG_2PI, betainc, betaln, digamma, kolmogorov, log_ndtr_between, ndtr
from plumbline.operators.model import STEP, nodes
from plumbline.sources.records import fresh

#: Limits of the parameters, and the 5 % point of the mixed chi-square law of a variance-like parameter at its edge.
NO_BULK, MOST_BULK, MOST_ALPHA, LAMBDAS, LEAST_NOISE, MOST_K, MOST_SIGMA, TAUS, EDGE = np.log(1e-12), np.log(1e15), 50.0, (np.log(1e-2), np.log(20)), np.log(1e-2), np.log(1e3), np.log(20.0), (np.log(1e-3), np.log(5.0)), 2.706


@dataclass(frozen=True)
class Term:
    """A source: its baseline groups, and how its values are distributed (negbin, lognormal, lognormal_sum)."""

    name: str
    groups: tuple[str, ...] = ("packages",)
    dist: str = "negbin"

    @property
    def size(self) -> int:
        return len(self.groups) + 3 + (self.dist == "lognormal_sum")

    def names(self) -> list[str]:
        noise = ["log k"] if self.dist == "negbin" else ["log sigma"]
        own = [f"log b[{g}]" for g in self.groups] + ["alpha", "log lambda", *noise] + ["log tau"] * (self.dist == "lognormal_sum")
        return [f"{self.name}: {n}" for n in own]

    def bounds(self) -> list[tuple[float, float]]:
        out = [(NO_BULK, MOST_BULK)] * len(self.groups) + [(-MOST_ALPHA, MOST_ALPHA), LAMBDAS, (LEAST_NOISE, MOST_K if self.dist == "negbin" else MOST_SIGMA)]
        return out + [TAUS] * (self.dist == "lognormal_sum")


@dataclass(frozen=True)
class Model:
    terms: tuple[Term, ...]

    @property
    def size(self) -> int:
        return sum(t.size for t in self.terms)

    def offsets(self) -> list[int]:
        return [0, *np.cumsum([t.size for t in self.terms]).tolist()]

    def names(self) -> list[str]:
        return [n for t in self.terms for n in t.names()]

    def bounds(self) -> np.ndarray:
        return np.array([b for t in self.terms for b in t.bounds()])

    def bulks(self) -> list[int]:
        return [at + k for t, at in zip(self.terms, self.offsets(), strict=False) for k in range(len(t.groups))]

    @property
    def width(self) -> int:
        return max(len(t.groups) for t in self.terms)


# --- likelihoods, in numpy ---------------------------------------------------------------------------------------


@dataclass
class Rows:
    """Rows of one term: value (or its low end), high end, factors by group, exposure, and the font's place in its batch."""

    y: np.ndarray
    high: np.ndarray
    n: np.ndarray
    e: np.ndarray
    at: np.ndarray

    @cached_property
    def distinct(self) -> tuple[Rows, np.ndarray]:
        """Rows that differ by more than their font, and which of them each row is: a likelihood is worked out once for all that are equal."""
        _, first, of = np.unique(np.column_stack([self.y, self.high, self.e, self.n]), axis=0, return_index=True, return_inverse=True)
        return Rows(self.y[first], self.high[first], self.n[first], self.e[first], self.at[first]), of.ravel()

    @cached_property
    def single(self) -> bool:
        """Whether no font has two rows (rows stand in the order of fonts)."""
        return not (np.diff(self.at) == 0).any()

    def summed(self, p: np.ndarray) -> np.ndarray:
        """Sums of the fonts' numbers by distinct row."""
        of = self.distinct[1]
        if not len(of):
            return np.zeros((0, p.shape[1]))
        order = np.argsort(of, kind="stable")
        return np.add.reduceat(p[self.at[order]], np.flatnonzero(np.diff(of[order], prepend=-1)))


def expected(term: Term, own: np.ndarray, r: Rows, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bulk and popularity of each row at each score."""
    g = len(term.groups)
    bulk = r.e * (r.n[:, :g] @ np.exp(own[:g]))
    return bulk[:, None], r.e[:, None] * np.exp(own[g] + np.exp(own[g + 1]) * x)[None, :]


def negbin(y: np.ndarray, mean: np.ndarray, k: float) -> np.ndarray:
    """Log-probability of a count; the coefficient by betaln, the rest by log1p, so that large counts keep their digits."""
    return -np.log(y + k) - betaln(k, y + 1) + k * (np.log(k) - np.log(k + mean)) - y * np.log1p(k / mean)


def negbin_between(low: np.ndarray, high: np.ndarray, mean: np.ndarray, k: float) -> np.ndarray:
    """Log-probability that a count lies in [low, high]."""
    p = k / (k + mean)
    above = np.where(low > 0, betainc(k, np.maximum(low, 1.0), p), 0.0)
    return np.log(np.maximum(betainc(k, high + 1, p) - above, 1e-300))


def log_moments(term: Term, own: np.ndarray, bulk: np.ndarray, popularity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sd of the value's logarithm. A sum of two log-normals takes those of the one with its mean and variance (Fenton and Wilkinson)."""
    g = len(term.groups)
    if term.dist == "lognormal":
        return np.log(bulk + popularity), np.full(popularity.shape, np.exp(own[g + 2]))
    s2, t2 = np.exp(2 * own[g + 2]), np.exp(2 * own[g + 3])
    b, p = np.log(np.maximum(bulk, 1e-300)) + t2 / 2, np.log(np.maximum(popularity, 1e-300)) + s2 / 2
    whole = np.logaddexp(b, p)
    spread = np.log1p(np.exp(2 * (b - whole)) * np.expm1(t2) + np.exp(2 * (p - whole)) * np.expm1(s2))
    return whole - spread / 2, np.sqrt(spread)


def lognormal(y: np.ndarray, high: np.ndarray, m: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Log-density of a value, or log-probability of [y, high] where that is wider than a point."""
    log_y = np.log(np.maximum(y, 1e-300))
    out = -0.5 * ((log_y - m) / s) ** 2 - np.log(s) - HALF_LOG_2PI - log_y
    wide = (high > y)[:, 0]
    if wide.any():
        mw, sw = m[wide], s[wide]
        low = np.where(y[wide] > 0, (log_y[wide] - mw) / sw, -1e150)
        out[wide] = log_ndtr_between(low, (np.log(high[wide]) - mw) / sw)
    return out


def loglik(term: Term, own: np.ndarray, r: Rows, x: np.ndarray) -> np.ndarray:
    bulk, popularity = expected(term, own, r, x)
    y, high = r.y[:, None], r.high[:, None]
    if term.dist != "negbin":
        return lognormal(y, high, *log_moments(term, own, bulk, popularity))
    mean, k = bulk + popularity, np.exp(own[len(term.groups) + 2])
    out = negbin(y, mean, k)
    wide = r.high > r.y
    if wide.any():
        out[wide] = negbin_between(y[wide], high[wide], mean[wide], k)
    return out


def slopes(term: Term, own: np.ndarray, r: Rows, x: np.ndarray) -> Iterator[np.ndarray]:
    """Derivatives of loglik by the term's parameters: closed ones for exact counts, central differences for the rest."""
    if term.dist == "negbin" and not (r.high > r.y).any():
        g, (bulk, popularity) = len(term.groups), expected(term, own, r, x)
        mean, k, y = bulk + popularity, np.exp(own[g + 2]), r.y[:, None]
        by_mean = y / mean - (y + k) / (k + mean)
        for j in range(g):
            yield by_mean * (r.e * r.n[:, j] * np.exp(own[j]))[:, None]
        yield by_mean * popularity
        yield by_mean * popularity * np.exp(own[g + 1]) * x
        yield k * (digamma(y + k) - digamma(np.array(k)) + np.log(k) + 1 - np.log(k + mean) - (y + k) / (k + mean))
        return
    if term.dist == "lognormal" and not (r.high > r.y).any():
        g, (bulk, popularity) = len(term.groups), expected(term, own, r, x)
        mean, sd = bulk + popularity, np.exp(own[g + 2])
        off = (np.log(np.maximum(r.y, 1e-300))[:, None] - np.log(mean)) / sd
        for j in range(g):
            yield off / sd * (r.e * r.n[:, j] * np.exp(own[j]))[:, None] / mean
        yield off / sd * popularity / mean
        yield off / sd * popularity / mean * np.exp(own[g + 1]) * x
        yield off * off - 1
        return
    for j in range(term.size):
        step = np.zeros(term.size)
        step[j] = 1e-5
        yield (loglik(term, own + step, r, x) - loglik(term, own - step, r, x)) / 2e-5


def below(term: Term, own: np.ndarray, r: Rows, x: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Probability that the value is at most v, at each score."""
    bulk, popularity = expected(term, own, r, x)
    v = v[:, None]
    if term.dist == "negbin":
        k = np.exp(own[len(term.groups) + 2])
        return np.where(v >= 0, betainc(k, np.maximum(v, 0) + 1, k / (k + bulk + popularity)), 0.0)
    m, s = log_moments(term, own, bulk, popularity)
    return np.where(v > 0, ndtr((np.log(np.maximum(v, 1e-300)) - m) / s), 0.0)


# --- fonts as rows ------------------------------------------------------------------------------------------------


@dataclass
class Batch:
    ids: pa.Array
    rows: list[Rows]
    size: int
    times: np.ndarray

    def weights(self, model: Model, theta: np.ndarray, x: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Log-likelihood times prior by font and node, and its parts by term."""
        total, parts, off = np.tile(w, (self.size, 1)), [], model.offsets()
        for k, (t, r) in enumerate(zip(model.terms, self.rows, strict=True)):
            few, of = r.distinct
            own = loglik(t, theta[off[k] : off[k + 1]], few, x)[of]
            if r.single:
                total[r.at] += own
            else:
                np.add.at(total, r.at, own)
            parts.append(own)
        return total, parts


def normed(log: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities by node, and the logarithm of their sum."""
    top = log.max(axis=1, keepdims=True)
    p = np.exp(log - top)
    whole = p.sum(axis=1, keepdims=True)
    return p / whole, (top + np.log(whole))[:, 0]


#: Fonts that a task integrates at once.
FONTS = 2048


def batches(model: Model, source: Iterator[pa.RecordBatch]) -> Iterator[Batch]:
    for whole in source:
        for at in range(0, whole.num_rows, FONTS):
            b = whole.slice(at, FONTS)
            ts = b.column("ts")
            flat, sizes = ts.flatten(), np.diff(np.asarray(ts.offsets))
            font = np.repeat(np.arange(b.num_rows), sizes)
            get = {c: flat.field(c).to_numpy(zero_copy_only=False) for c in ("t", "y", "high", "e", *[f"n{k}" for k in range(model.width)])}
            n = np.column_stack([get[f"n{k}"] for k in range(model.width)])
            rows = []
            for k in range(len(model.terms)):
                own = get["t"] == k
                rows.append(Rows(get["y"][own], get["high"][own], n[own], get["e"][own], font[own]))
            times = b.column("times").to_numpy() if "times" in b.schema.names else np.ones(b.num_rows)
            yield Batch(b.column("id"), rows, b.num_rows, times)


def grid() -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.array(z) for z in zip(*nodes(), strict=True))


@dataclass
class Fonts:
    """Fonts with their terms, written once; every pass over them is one job."""

    model: Model
    table: DataFrame

    @staticmethod
    def of(counts: DataFrame, model: Model) -> Fonts:
        """counts: a row per font and term with id, term, y, and, if there, high (null: exact), n (array by group, default 1) and e (default 1).

        Null values and terms that the model doesn't have are left out. A zero of a log-normal term means
        "under 1". A repeated font and term counts twice.
        """
        has = set(counts.columns)
        place = F.create_map(*[F.lit(z) for k, t in enumerate(model.terms) for z in (t.name, k)])[F.col("term")]
        logs = F.array_contains(F.array(*[F.lit(t.name) for t in model.terms if t.dist != "negbin"] or [F.lit("")]), F.col("term"))
        y = F.col("y").cast("double")
        high = F.coalesce(F.col("high").cast("double"), y) if "high" in has else y
        high = F.when(logs & (y == 0) & (high <= 0), 1.0).otherwise(F.greatest(high, y))
        n = [F.coalesce(F.get("n", F.lit(k)).cast("double"), F.lit(0.0)) if "n" in has else F.lit(1.0 if k == 0 else 0.0) for k in range(model.width)]
        e = F.coalesce(F.col("e").cast("double"), F.lit(1.0)) if "e" in has else F.lit(1.0)
        rows = counts.where(y.isNotNull() & place.isNotNull()).select("id", F.struct(place.alias("t"), y.alias("y"), high.alias("high"), e.alias("e"), *[c.alias(f"n{k}") for k, c in enumerate(n)]).alias("x"))
        grouped = rows.groupBy("id").agg(F.sort_array(F.collect_list("x")).alias("ts"))  # as many as there are terms
        return Fonts(model, Fonts.dealt(grouped))

    @staticmethod
    def dealt(rows: DataFrame) -> DataFrame:
        """rows written in as many files as tasks can run: they are small, but the work on each is not, so sizes must not decide."""
        path, spark = fresh(rows.sparkSession, "fonts"), rows.sparkSession
        rows.repartition(spark.sparkContext.defaultParallelism, "id").write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    def merged(self) -> Fonts:
        """Fonts whose terms are all equal as one (id: the least), which counts as many times: for objective() alone."""
        return Fonts(self.model, Fonts.dealt(self.table.groupBy("ts").agg(F.min("id").alias("id"), F.count(F.lit(1)).cast("double").alias("times")).select("id", "ts", "times")))

    def each(self, rows: Callable[[Batch], pa.RecordBatch], schema: str) -> DataFrame:
        model = self.model

        def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches(model, source):
                yield rows(b)

        return self.table.mapInArrow(run, schema)

    def objective(self, thetas: list[np.ndarray], gradients: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihoods at parameter vectors, and the gradients of the first ones (all, if not told how many): one job, a few numbers by task and vector."""
        model, (x, w), size = self.model, grid(), 1 + self.model.size
        gradients = len(thetas) if gradients is None else gradients
        off = model.offsets()

        def sums(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((len(thetas), size))
            for b in batches(model, source):
                for i, theta in enumerate(thetas):
                    total, _ = b.weights(model, theta, x, w)
                    p, whole = normed(total)
                    out[i, 0] += (whole * b.times).sum()
                    if i >= gradients:
                        continue
                    p *= b.times[:, None]
                    for k, (t, r) in enumerate(zip(model.terms, b.rows, strict=True)):
                        here = r.summed(p)
                        for j, d in enumerate(slopes(t, theta[off[k] : off[k + 1]], r.distinct[0], x)):
                            out[i, 1 + off[k] + j] += (d * here).sum()
            yield pa.RecordBatch.from_pydict({"k": np.arange(out.size), "v": out.ravel()})

        found = self.table.mapInArrow(sums, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
        out = np.zeros(len(thetas) * size)
        for r in found:
            out[r["k"]] = r["v"]
        out = out.reshape(len(thetas), size)
        return out[:, 0], out[:gradients, 1:]


# --- the fit ----------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Fit:
    model: Model
    theta: np.ndarray
    loglik: float
    cov: np.ndarray
    converged: bool
    free: tuple[int, ...]
    held: tuple[str, ...] = ()
    at_bound: tuple[str, ...] = ()
    jobs: int = field(default=0, compare=False)

    def record(self) -> str:
        """The fit as JSON that reads back to the same bits."""
        terms = [{"name": t.name, "dist": t.dist, "groups": list(t.groups)} for t in self.model.terms]
        part = self.cov[np.ix_(self.free, self.free)].tolist()
        return json.dumps({"terms": terms, "names": self.model.names(), "theta": self.theta.tolist(), "loglik": self.loglik, "free": list(self.free), "cov": part, "converged": self.converged, "held": list(self.held), "at_bound": list(self.at_bound)}, sort_keys=True)

    @staticmethod
    def of_record(text: str) -> Fit:
        r = json.loads(text)
        model = Model(tuple(Term(t["name"], tuple(t["groups"]), t["dist"]) for t in r["terms"]))
        cov, free = np.zeros((model.size, model.size)), tuple(r["free"])
        cov[np.ix_(free, free)] = np.array(r["cov"]).reshape(len(free), len(free))
        return Fit(model, np.array(r["theta"]), r["loglik"], cov, r["converged"], free, tuple(r["held"]), tuple(r["at_bound"]))

    def rows(self) -> list[tuple]:
        """(parameter, estimate, standard error, state) in order."""
        names = self.model.names()
        state = {i: "free" for i in self.free} | {i: "at bound" for i, n in enumerate(names) if n in self.at_bound}
        return [(n, float(self.theta[i]), float(np.sqrt(self.cov[i, i])) if i in self.free and self.cov[i, i] > 0 else None, state.get(i, "held")) for i, n in enumerate(names)]


def start_of(fonts: Fonts) -> np.ndarray:
    """Parameters to start from: half the median rate for a bulk, the median rate for the popularity."""
    t = fonts.table.select(F.explode("ts").alias("t")).select("t.*")
    rate = F.col("y") / F.col("e")
    cuts = {r["t"]: r for r in t.groupBy("t").agg(F.percentile_approx(rate, 0.5).alias("all"), *[F.percentile_approx(F.when(F.col(f"n{k}") > 0, rate), 0.5).alias(f"n{k}") for k in range(fonts.model.width)]).collect()}
    out = []
    for k, term in enumerate(fonts.model.terms):
        r = cuts.get(k)
        known = lambda v: np.log(max(v, 1e-12)) if v is not None else NO_BULK
        out += [known(r[f"n{j}"] / 2 if r and r[f"n{j}"] is not None else None) for j in range(len(term.groups))]
        out += [known(r["all"] if r else 1.0), 0.0, 0.0] + [np.log(0.3)] * (term.dist == "lognormal_sum")
    b = fonts.model.bounds()
    return np.clip(np.array(out), b[:, 0], b[:, 1])


#: Step lengths that one job tries at once; the projected gradient, and the gain that the curvature foretells, under which a maximum is reached.
LENGTHS, TOLERANCE, GAIN = (1.0, 0.5, 0.2, 0.05, 0.01), 1e-4, 1e-6


def climb(value: Callable[..., tuple[np.ndarray, np.ndarray]], start: np.ndarray, bounds: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, float, bool]:
    """A maximum within the box, by a quasi-Newton search; value(points, how many gradients) gives values and gradients.

    Parameters at a bound that the gradient pushes outwards rest; the others go along the inverse of the
    curvature that past steps have shown, several lengths at a time. Found: the projected gradient is
    under TOLERANCE, or the next step would gain less than GAIN. A direction that gains nothing is
    given up for the gradient, once; if that gains nothing either, the search has failed.
    """
    lo, hi = bounds[:, 0], bounds[:, 1]
    x = np.clip(start, lo, hi)
    f, g = (z[0] for z in value([x], 1))
    inverse, fresh = np.eye(len(x)), True
    for _ in range(rounds):
        move = ~((hi <= lo) | ((x <= lo) & (g < 0)) | ((x >= hi) & (g > 0)))
        if not move.any() or np.abs(np.clip(x + g, lo, hi) - x)[move].max() < TOLERANCE:
            return x, float(f), True
        d = np.zeros(len(x))
        d[move] = inverse[np.ix_(move, move)] @ g[move]
        if d @ g <= 0:
            inverse, fresh = np.eye(len(x)), True
            d[move] = g[move]
        if not fresh and 0.5 * (d @ g) < GAIN:
            return x, float(f), True
        d = d * min(1.0, (1.0 if fresh else 3.0) / np.abs(d).max())
        lengths = (*LENGTHS, 1e-3, 1e-4, 1e-5) if fresh else LENGTHS
        tries = [np.clip(x + s * d, lo, hi) for s in lengths]
        fs, gs = value(tries, 1)
        best = int(np.argmax(np.where(np.isfinite(fs), fs, -np.inf)))
        if not fs[best] > f:
            if fresh:
                return x, float(f), False
            inverse, fresh = np.eye(len(x)), True
            continue
        slope = gs[0] if best == 0 else value([tries[best]], 1)[1][0]
        s, y = tries[best] - x, g - slope
        x, f, g = tries[best], fs[best], slope
        if s @ y > 1e-10 * np.linalg.norm(s) * np.linalg.norm(y):
            if fresh:
                inverse = np.eye(len(x)) * (s @ y) / (y @ y)
            turn = np.eye(len(x)) - np.outer(s, y) / (s @ y)
            inverse = turn @ inverse @ turn.T + np.outer(s, s) / (s @ y)
            fresh = False
    return x, float(f), False


def covariance(fonts: Fonts, theta: np.ndarray, free: list[int], step: float = 1e-4) -> np.ndarray:
    """Inverse observed information of the free parameters (zero elsewhere), by central differences of the gradient: one job."""
    out = np.zeros((len(theta), len(theta)))
    if not free:
        return out
    moved = [theta + s * step * np.eye(len(theta))[i] for i in free for s in (1, -1)]
    _, g = fonts.objective(moved)
    h = np.array([-(g[2 * k] - g[2 * k + 1])[free] / (2 * step) for k in range(len(free))])
    try:
        out[np.ix_(free, free)] = np.linalg.inv((h + h.T) / 2)
    except np.linalg.LinAlgError:
        out[np.ix_(free, free)] = np.nan
    return out


def fit(counts: DataFrame, model: Model, start: np.ndarray | None = None, fixed: dict[int, float] | None = None, hold: bool = True, rounds: int = 200) -> Fit:
    """Marginal maximum likelihood of all parameters, with their covariance.

    With `hold`, a bulk that the data can't tell from none is held at none: one at its lower bound or
    under which nothing expects 0.01 of a count at once, and one with a flat likelihood (standard error
    undefined or over 2) unless twice the loss in log-likelihood is EDGE or more. A search ends after `rounds`
    steps, and is then not converged.
    """
    every = Fonts.of(counts, model)
    fonts, names, jobs = every.merged(), model.names(), [0]

    def value(thetas: list[np.ndarray], gradients: int) -> tuple[np.ndarray, np.ndarray]:
        jobs[0] += 1
        return fonts.objective(thetas, gradients)

    def search(at: np.ndarray, fixed: dict[int, float]) -> tuple[np.ndarray, float, bool]:
        bounds, at = model.bounds(), at.copy()
        for i, v in fixed.items():
            at[i] = v
            bounds[i] = v
        return climb(value, at, bounds, rounds)

    scale = fonts.table.select(F.explode("ts").alias("t")).groupBy("t.t").agg(*[F.max(F.col(f"t.n{k}") * F.col("t.e")).alias(f"n{k}") for k in range(model.width)]).collect()
    scale = {r["t"]: r for r in scale}
    off = model.offsets()
    most = {off[k] + j: (scale[k][f"n{j}"] if k in scale else 0.0) for k, t in enumerate(model.terms) for j in range(len(t.groups))}
    fixed, held = dict(fixed or {}), []
    theta, ll, ok = search(start_of(every) if start is None else np.array(start, float), fixed)
    while True:
        empty = [i for i in model.bulks() if i not in fixed and (theta[i] <= NO_BULK + 1e-6 or np.exp(theta[i]) * most[i] < 0.01)] if hold else []
        if empty:
            fixed |= dict.fromkeys(empty, NO_BULK)
            held += [names[i] for i in empty]
            theta, ll, ok = search(theta, fixed)
            continue
        free = [i for i in range(model.size) if i not in fixed]
        cov = covariance(fonts, theta, free)
        jobs[0] += 1
        var = np.diag(cov)
        flat = [i for i in model.bulks() if i in free and not 0 < var[i] <= 4.0] if hold else []
        changed = False
        for i in sorted(flat, key=lambda i: -var[i] if np.isfinite(var[i]) else -np.inf):
            other, other_ll, other_ok = search(theta, {**fixed, i: NO_BULK})
            if 2 * (ll - other_ll) < EDGE:
                fixed[i], theta, ll, ok, changed = NO_BULK, other, other_ll, other_ok, True
                held.append(f"{names[i]} (likelihood ratio)")
        if not changed:
            break
    bounds = model.bounds()
    edge = tuple(names[i] for i in free if min(abs(theta[i] - bounds[i, 0]), abs(theta[i] - bounds[i, 1])) < 1e-6)
    return Fit(model, theta, ll, cov, ok, tuple(free), tuple(held), edge, jobs[0])


# --- what a fit says ------------------------------------------------------------------------------------------------


def scores(fonts: Fonts, theta: np.ndarray) -> DataFrame:
    """(id, mean, sd, evidence) of every font."""
    model, (x, w) = fonts.model, grid()

    def rows(b: Batch) -> pa.RecordBatch:
        p, whole = normed(b.weights(model, theta, x, w)[0])
        mean = p @ x
        return pa.RecordBatch.from_arrays([b.ids, pa.array(mean), pa.array(np.sqrt(np.maximum(p @ (x * x) - mean * mean, 0.0))), pa.array(whole)], ["id", "mean", "sd", "evidence"])

    return fonts.each(rows, f"id {fonts.table.schema['id'].dataType.simpleString()}, mean double, sd double, evidence double")


def left_out(fonts: Fonts, theta: np.ndarray) -> DataFrame:
    """(id, term, low, high): each value's predictive probabilities of less (low) and of at most (high) under the font's other terms.

    A count has an interval between the two, a log-normal value is a point, unless it is an interval itself.
    """
    model, (x, w), off = fonts.model, grid(), fonts.model.offsets()

    def rows(b: Batch) -> pa.RecordBatch:
        total, parts = b.weights(model, theta, x, w)
        at, names, low, high = [], [], [], []
        for k, (t, r, own) in enumerate(zip(model.terms, b.rows, parts, strict=True)):
            p, _ = normed(total[r.at] - own)
            mine = theta[off[k] : off[k + 1]]
            under = r.y - 1 if t.dist == "negbin" else r.y
            low.append((p * below(t, mine, r, x, under)).sum(axis=1))
            high.append((p * below(t, mine, r, x, r.high)).sum(axis=1))
            at.append(r.at)
            names += [t.name] * len(r.at)
        return pa.RecordBatch.from_arrays([b.ids.take(pa.array(np.concatenate(at))), pa.array(names, pa.string()), pa.array(np.concatenate(low)), pa.array(np.concatenate(high))], ["id", "term", "low", "high"])

    return fonts.each(rows, f"id {fonts.table.schema['id'].dataType.simpleString()}, term string, low double, high double")


def conflicts(left: DataFrame, tail: float) -> DataFrame:
    """left_out rows whose whole interval lies in a tail: sources that contradict a font's others."""
    return left.where((F.col("high") < tail) | (F.col("low") > 1 - tail))


def calibration(left: DataFrame, seed: int = 2) -> DataFrame:
    """By term: fonts, ks (largest distance of the randomised places from a uniform law), z_sd, low_tail, high_tail.

    A place is drawn between low and high by a hash of id and term, so one font's doesn't hang on another.
    """
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("id"), F.col("term")), 11) / float(1 << 53)
    u = F.least(F.greatest(F.col("low") + draw * (F.col("high") - F.col("low")), F.lit(1e-12)), F.lit(1 - 1e-12))
    placed = left.select("term", u.alias("u"))
    blocks = tie_blocks(placed, ["term"], "u")
    far = F.greatest((F.col("lower") + F.col("here")) / F.col("n") - F.col("u"), F.col("u") - F.col("lower") / F.col("n"))
    z = probit(F.col("u"))
    shares = placed.groupBy("term").agg(F.count(F.lit(1)).alias("fonts"), F.stddev_pop(z).alias("z_sd"), F.avg((F.col("u") < 0.05).cast("int")).alias("low_tail"), F.avg((F.col("u") > 0.95).cast("int")).alias("high_tail"))
    return shares.join(blocks.groupBy("term").agg(F.max(far).alias("ks")), "term").select("term", "fonts", "ks", "z_sd", "low_tail", "high_tail")


def ks_probability(ks: float, fonts: int) -> float:
    return kolmogorov(ks, fonts)


def drawn(fit: Fit, fonts: Fonts, draws: int = 200, seed: int = 0) -> DataFrame:
    """(draw, id, score): one score of every font in each joint draw of parameters and scores.

    Parameters come from the fit's normal law (free ones alone) on the driver, `draws` vectors; a font's
    score comes from its posterior at them, by a number made of its id and the draw.
    """
    model, (x, w) = fonts.model, grid()
    rng = np.random.default_rng(seed)
    free = list(fit.free)
    noise = rng.multivariate_normal(np.zeros(len(free)), fit.cov[np.ix_(free, free)], size=draws, method="eigh") if free else np.zeros((draws, 0))
    thetas = np.tile(fit.theta, (draws, 1))
    thetas[:, free] += noise
    bounds = model.bounds()
    thetas = np.clip(thetas, bounds[:, 0], bounds[:, 1])

    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pandas as pd

        for b in batches(model, source):
            keys = pd.util.hash_array(np.asarray(b.ids.to_pandas())).astype(np.uint64)
            for r in range(draws):
                p, _ = normed(b.weights(model, thetas[r], x, w)[0])
                mix = (keys ^ np.uint64((r + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xD1B54A32D192ED03)
                u = ((mix ^ (mix >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) >> np.uint64(11)) / float(1 << 53)
                sums = np.cumsum(p, axis=1)
                k = np.minimum((sums < u[:, None]).sum(axis=1), len(x) - 1)
                before = np.where(k > 0, np.take_along_axis(sums, np.maximum(k - 1, 0)[:, None], 1)[:, 0], 0.0)
                inside = (u - before) / np.maximum(np.take_along_axis(p, k[:, None], 1)[:, 0], 1e-300)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(b.size, r)), b.ids, pa.array(x[k] + STEP * (np.clip(inside, 0, 1) - 0.5))], ["draw", "id", "score"])

    return fonts.table.mapInArrow(rows, f"draw long, id {fonts.table.schema['id'].dataType.simpleString()}, score double")


def rank_ranges(draws: DataFrame, share: float = 0.9) -> DataFrame:
    """(id, low, high): the ranks between which a font lies in `share` of the draws."""
    ranks = row_numbers(draws, ["draw"], "score", [F.desc("score"), "id"], "rank", falling=True)
    cut = lambda q: F.expr(f"percentile_disc({q}) within group (order by rank)").cast("long")
    return ranks.groupBy("id").agg(cut((1 - share) / 2).alias("low"), cut(1 - (1 - share) / 2).alias("high"))


def falls(fit: Fit, fonts: Fonts, points: int = 2000) -> DataFrame:
    """By term: how often a font's score falls as its only count rises, over `points` counts from a twentieth of the least to ten times the largest one, and the largest fall."""
    spark, model = fonts.table.sparkSession, fonts.model
    t = fonts.table.select(F.explode("ts").alias("t")).select("t.*")
    own = t.groupBy("t").agg(F.min(F.when(F.col("y") > 0, F.col("y"))).alias("least"), F.max("y").alias("most"), F.percentile_approx("e", 0.5).alias("e"), *[F.percentile_approx(f"n{k}", 0.5).alias(f"n{k}") for k in range(model.width)]).where("least is not null")
    y = F.col("least") / 20 * F.pow(F.col("most") * 200 / F.col("least"), F.col("i") / F.lit(points - 1.0))
    name = F.element_at(F.array(*[F.lit(x.name) for x in model.terms]), F.col("t") + 1)
    probes = own.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    probes = probes.select((F.col("t").cast("long") * points + F.col("i")).alias("id"), name.alias("term"), y.alias("y"), "e", F.array(*[F.col(f"n{k}") for k in range(model.width)]).alias("n"))
    found = scores(Fonts.of(probes, model), fit.theta).select("id", "mean", F.floor(F.col("id") / points).alias("t"))
    step = F.col("mean") - F.lag("mean").over(Window.partitionBy("t").orderBy("id"))  # `points` rows a term
    found = found.withColumn("step", step).groupBy("t").agg(F.count_if(F.col("step") < -1e-9).alias("falls"), F.greatest(-F.min("step"), F.lit(0.0)).alias("largest"))
    names = spark.createDataFrame([(k, x.name) for k, x in enumerate(model.terms)], "t long, term string")
    return found.join(F.broadcast(names), "t").select("term", "falls", F.when(F.col("falls") > 0, F.col("largest")).otherwise(0.0).alias("largest"))


def simulated(fonts: DataFrame, model: Model, theta: np.ndarray, seed: int = 0) -> DataFrame:
    """(id, term, y) of fonts (id, score): one value by term, with n and e 1; a font's draws hang on its id alone.

    A sum of two log-normals is drawn as one, not by its moments.
    """
    off, kind = model.offsets(), fonts.schema["id"].dataType.simpleString()

    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in source:
            out = {"id": [], "term": [], "y": []}
            for key, score in zip(b.column("id").to_pylist(), b.column("score").to_pylist(), strict=True):
                rng = np.random.default_rng([seed, *str(key).encode()])
                for k, t in enumerate(model.terms):
                    own, g = theta[off[k] : off[k + 1]], len(t.groups)
                    bulk, popularity, noise = np.exp(own[0]), np.exp(own[g] + np.exp(own[g + 1]) * score), np.exp(own[g + 2])
                    if t.dist == "negbin":
                        y = float(rng.poisson((bulk + popularity) * rng.gamma(noise) / noise))
                    elif t.dist == "lognormal":
                        y = (bulk + popularity) * np.exp(noise * rng.standard_normal())
                    else:
                        y = bulk * np.exp(np.exp(own[g + 3]) * rng.standard_normal()) + popularity * np.exp(noise * rng.standard_normal())
                    out["id"].append(key)
                    out["term"].append(t.name)
                    out["y"].append(y)
            yield pa.RecordBatch.from_arrays([pa.array(out["id"], b.column("id").type), pa.array(out["term"], pa.string()), pa.array(out["y"], pa.float64())], ["id", "term", "y"])

    return fonts.select("id", F.col("score").cast("double")).mapInArrow(rows, f"id {kind}, term string, y double")
