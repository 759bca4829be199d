"""Quality classifier by co-training a text view and a metadata view.

The text view sees a text alone: its words (hashed) and shapes. The metadata view sees what is declared
about it and nothing of the text: source, language and length. Both are logistic regressions, fitted on
the same labelled sample. In each round either view gives its most confident pseudo-labels for
unlabelled texts to the other one. The candidates for that are the surest texts of either view among
all documents, found by one pass over them. Each view is then calibrated on labelled texts held back,
and the calibrated views are combined there. Two such models are made, for quality and for toxicity; a
text is kept if it is likely good and not clearly toxic. Fitting works on a bounded sample of labelled
texts; finding candidates and scoring cover all texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import body, small_batches, written
from plumbline.llm.grams import LOWER, Spans
from plumbline.llm.repeats import slices
from plumbline.llm.text_stats import SHARES, statistics

#: Labelled texts that the views are fitted on at most, of the least hashes of their ids; and how many of the
#: surest texts of all documents either view brings forward for each class.
LABELLED, SUREST = 8000, 400
#: Hashed words; rounds of co-training; share of the unlabelled texts that a view passes on a round.
WORD_BITS, ROUNDS, SHARE = 24, 3, 0.1
WORDS = 1 << WORD_BITS
#: Bytes of a longer word's stem, which counts as a word of its own.
STEM = 6
#: Texts of the sample that a word must be in to count.
LEAST_TEXTS = 6
#: How far from chance its share of good texts must be.
CHI_SQUARE = 30.0
#: A share counts as such, and by whether it reaches each of these.
STEPS = (0.03, 0.1, 0.3)
#: A text is rejected if its quality is less likely than the first, or its toxicity likelier than the second.
GOOD, TOXIC = 0.3, 0.6
#: Texts of the labelled sample held back for calibration: one in so many.
HELD = 4
SOURCES, LANGS = 64, 16
#: Declared lengths (characters) that the metadata view tells apart.
LENGTHS = (50, 200, 1000, 5000, 20000)
MODELS = ("quality", "toxic")


def text_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """(text, word) pairs of the texts' distinct hashed words and stems, dense text features, and all statistics."""
    stats = statistics(data, starts, ends)
    words, n = stats.words, len(starts)
    # Punctuation around a word is not part of it here.
    letters = ~np.isin(data, np.frombuffer(b".,;:!?()\"'*#$%&|<>", dtype=np.uint8))
    kept = np.concatenate([[0], np.cumsum(letters)])
    last = words.end.copy()
    for _ in range(3):
        shorter = (last - 1 > words.start) & ~letters[np.maximum(last - 1, 0)]
        last[shorter] -= 1
    some = kept[last] > kept[words.start]
    spans, start, last, text = Spans(LOWER[data]), words.start[some], last[some], words.text[some]
    long = last - start > STEM
    prints = np.concatenate([spans.prints(start, last)[0], spans.prints(start[long], start[long] + STEM, 1)[0]]).view(np.uint64)
    pairs = np.unique(np.concatenate([text, text[long]]) * WORDS + (prints >> np.uint64(64 - WORD_BITS)).astype(np.int64))
    counts = stats.counts
    dense = np.stack([np.where(counts[b] > 0, counts[a] / np.maximum(counts[b], 1), 0.0) for _, a, b in SHARES], axis=1)
    dense = np.concatenate([dense, *[dense[:, :-1] >= s for s in STEPS]], axis=1)
    return pairs // WORDS, pairs % WORDS, dense, counts


def meta_features(source: pd.Series, lang: pd.Series, declared: pd.Series) -> np.ndarray:
    """Features of what is declared: source and language (hashed), and length, which may be missing."""
    out = np.zeros((len(source), SOURCES + LANGS + 2 + len(LENGTHS)))
    rows = np.arange(len(source))
    out[rows, [zlib.crc32(str(x).encode()) % SOURCES for x in source]] = 1
    out[rows, [SOURCES + zlib.crc32(str(x).encode()) % LANGS for x in lang]] = 1
    chars = pd.to_numeric(declared, errors="coerce").to_numpy(dtype=float, na_value=np.nan)
    known = ~np.isnan(chars) & (chars >= 0)
    at = SOURCES + LANGS
    out[:, at] = known
    out[known, at + 1] = np.log1p(chars[known])
    for k, least in enumerate(LENGTHS):
        out[known, at + 2 + k] = chars[known] >= least
    return out


def lengths(of: np.ndarray, n: int) -> np.ndarray:
    """What one telling word counts in each text: the less, the more different ones it has."""
    return 2 / np.sqrt(np.maximum(np.bincount(of, minlength=n), 1))


@dataclass
class View:
    """A logistic regression on dense features and, if given, on hashed words."""

    dense: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    names: np.ndarray  # telling words, sorted
    words: np.ndarray  # their weights
    bias: float = 0.0

    @staticmethod
    def fit(dense: np.ndarray, of: np.ndarray, word: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 120) -> View:
        """Adam on the whole sample; of/word: the (row, hashed word) pairs, empty for a view without words."""
        mean, scale = dense.mean(axis=0), dense.std(axis=0) + 1e-2
        x = np.clip((dense - mean) / scale, -3, 3)
        # Other words would be learned by heart: those of few texts, or spread as by chance (chi-square).
        own, word = np.unique(word, return_inverse=True)
        total, hits = np.bincount(word, minlength=len(own)), np.bincount(word, weights=y[of], minlength=len(own))
        mean_y = min(max(float(y.mean()), 1e-6), 1 - 1e-6)
        far = np.maximum(np.abs(hits - total * mean_y) - 0.5, 0)
        telling = (total >= LEAST_TEXTS) & (far**2 > CHI_SQUARE * total * mean_y * (1 - mean_y))
        of, word = of[telling[word]], word[telling[word]]
        kept, word = np.unique(word, return_inverse=True)
        names = own[kept]
        value = lengths(of, len(y))[of]
        theta = [np.zeros(x.shape[1]), np.zeros(len(names)), np.zeros(1)]
        first, second = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
        decay = (2e-4, 1e-5, 0.0)
        for step in range(1, steps + 1):
            z = x @ theta[0] + theta[2][0]
            if len(of):
                z = z + np.bincount(of, weights=theta[1][word] * value, minlength=len(y))
            error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / weight.sum()
            slopes = [x.T @ error, np.bincount(word, weights=error[of] * value, minlength=len(names)), np.array([error.sum()])]
            for k, slope in enumerate(slopes):
                slope = slope + decay[k] * theta[k]
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.99 * second[k] + 0.01 * slope**2
                theta[k] -= 0.1 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
        return View(theta[0], mean, scale, names, theta[1], float(theta[2][0]))

    def logit(self, dense: np.ndarray, of: np.ndarray, word: np.ndarray) -> np.ndarray:
        z = np.clip((dense - self.mean) / self.scale, -3, 3) @ self.dense + self.bias
        if len(self.words):
            at = np.minimum(np.searchsorted(self.names, word), len(self.names) - 1)
            known = self.names[at] == word
            of, weight = of[known], self.words[at[known]]
            z = z + np.bincount(of, weights=weight, minlength=len(dense)) * lengths(of, len(dense))
        return z


@dataclass
class Model:
    """Two views, and how their logits combine (calibrated on texts held back)."""

    text: View
    meta: View
    text_slope: tuple[float, float]
    meta_slope: tuple[float, float]
    mix: tuple[float, float, float]

    def probability(self, t: np.ndarray, m: np.ndarray) -> np.ndarray:
        z = self.mix[0] * (self.text_slope[0] * t + self.text_slope[1]) + self.mix[1] * (self.meta_slope[0] * m + self.meta_slope[1]) + self.mix[2]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def platt(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights and bias of a small logistic regression, by Newton steps on smoothed targets."""
    x = np.column_stack([x, np.ones(len(x))])
    good, bad = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - target) + ridge * w
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def rows_of(of: np.ndarray, word: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of the chosen rows, numbered anew."""
    place = np.full(n, -1, dtype=np.int32)
    place[rows] = np.arange(len(rows), dtype=np.int32)
    own = place[of] >= 0
    return place[of[own]], word[own]


def split(y: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Rows to learn from and rows held back, of those with a label; None if a class is all but missing."""
    known = np.flatnonzero(y >= 0)
    if min((y == 1).sum(), (y == 0).sum()) < 8:
        return None
    held = known[np.arange(len(known)) % HELD == 0]
    return np.setdiff1d(known, held), held


def cotrain(dense: np.ndarray, meta: np.ndarray, of: np.ndarray, word: np.ndarray, y: np.ndarray, rounds: int = ROUNDS) -> Model | None:
    """A model from labels y (0 or 1; -1 where unlabelled), or None if a class is all but missing."""
    n, parts = len(y), split(y)
    if parts is None:
        return None
    train, held = parts
    free = np.flatnonzero(y < 0)
    share = float((y[train] == 1).mean())
    own = [{int(r): (int(y[r]), 1.0) for r in train} for _ in range(2)]
    none = np.zeros(0, dtype=np.int64)

    def fit(view: int, steps: int) -> View:
        rows = np.array(sorted(own[view]))
        target = np.array([own[view][int(r)][0] for r in rows], dtype=float)
        weight = np.array([own[view][int(r)][1] for r in rows])
        return View.fit(dense[rows], *rows_of(of, word, rows, n), target, weight, steps) if view == 0 else View.fit(meta[rows], none, none, target, weight, steps)

    views = [fit(0, 150), fit(1, 100)]
    for k in range(rounds if len(free) else 0):
        for view in (0, 1):
            z = views[view].logit(dense if view == 0 else meta, of if view == 0 else none, word if view == 0 else none)
            other = own[1 - view]
            left = free[[int(r) not in other for r in free]]
            if not len(left):
                continue
            order = left[np.argsort(z[left], kind="stable")]
            count = max(1, int(len(free) * SHARE))
            # Classes come in their share; only sure labels go over, with less weight than given ones.
            for r in order[-max(1, int(count * share)) :]:
                if z[r] > 2:
                    other[int(r)] = (1, 0.3)
            for r in order[: max(1, int(count * (1 - share)))]:
                if z[r] < -2:
                    other[int(r)] = (0, 0.3)
        views = [fit(0, 400 if k + 1 == rounds else 100), fit(1, 100)]
    t, m = views[0].logit(dense, of, word)[held], views[1].logit(meta, none, none)[held]
    target = (y[held] == 1).astype(float)
    ts, ms = platt(t[:, None], target), platt(m[:, None], target)
    mix = platt(np.column_stack([ts[0] * t + ts[1], ms[0] * m + ms[1]]), target)
    return Model(views[0], views[1], tuple(ts), tuple(ms), tuple(mix))


@dataclass
class Sample:
    """Features and labels of chosen texts, one of each doc_id (of several, the one of the least text)."""

    dense: np.ndarray
    meta: np.ndarray
    of: np.ndarray
    word: np.ndarray
    labels: dict[str, np.ndarray]


def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for own, data, starts, ends in slices(batches):
        of, word, dense, _ = text_features(data, starts, ends)
        meta = meta_features(own["source"], own["lang"], own["declared"])
        cut = np.searchsorted(of, np.arange(len(own) + 1))
        yield pd.DataFrame({"doc_id": own["doc_id"].array, "quality": own["quality"].array, "toxic": own["toxic"].array, "print": own["print"].array, "words": [word[a:b].astype(np.int32) for a, b in zip(cut[:-1], cut[1:], strict=True)], "dense": [*dense], "meta": [*meta]})


def sample_of(docs: DataFrame, chosen: DataFrame) -> Sample | None:
    """The rows of docs that chosen (doc_id, quality, toxic: bounded, so broadcast) names; None if there are none."""
    rows = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "source", "lang", "declared", F.coalesce("quality", F.lit(-1)).alias("quality"), F.coalesce("toxic", F.lit(-1)).alias("toxic"), "t", F.sha2("t", 256).alias("print"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    # As many rows as are chosen (and their copies), of WORDS hashed words each at most.
    table = rows.mapInPandas(features, f"doc_id {kind}, quality int, toxic int, print string, words array<int>, dense array<double>, meta array<double>").toPandas()
    if not len(table):
        return None
    table = table.sort_values(["doc_id", "print"], ignore_index=True).drop_duplicates("doc_id", ignore_index=True)
    sizes = table["words"].map(len).to_numpy()
    # Rows and hashed words fit into 32 bits; there are millions of pairs.
    word = np.concatenate([np.asarray(w, dtype=np.int32) for w in table.pop("words")]) if sizes.sum() else np.zeros(0, dtype=np.int32)
    return Sample(np.stack(table.pop("dense")), np.stack(table.pop("meta")), np.repeat(np.arange(len(table), dtype=np.int32), sizes), word, {m: table[m].to_numpy() for m in MODELS})


def frequent(of: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of words that are in LEAST_TEXTS of the texts or more; a view of some of the texts has no use for others."""
    ordered = np.sort(word)
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(word) else np.zeros(0, dtype=np.int64)
    often = ordered[first][np.diff(np.concatenate([first, [len(word)]])) >= LEAST_TEXTS]
    at = np.minimum(np.searchsorted(often, word), max(len(often) - 1, 0))
    kept = often[at] == word if len(often) else np.zeros(len(word), dtype=bool)
    return of[kept], word[kept]


def surest(docs: DataFrame, known: DataFrame, first: dict[str, tuple[View, View]], count: int) -> DataFrame:
    """doc_ids of the unlabelled texts of which a view is surest: `count` by model, view and class, among all docs."""
    views = docs.sparkSession.sparkContext.broadcast(first)
    kind = docs.schema["doc_id"].dataType.simpleString()
    none = np.zeros(0, dtype=np.int64)

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[str, pd.DataFrame] = {}
        for own, data, starts, ends in slices(batches):
            of, word, dense, _ = text_features(data, starts, ends)
            meta = meta_features(own["source"], own["lang"], own["declared"])
            for name, (text, other) in views.value.items():
                for view, z in (("text", text.logit(dense, of, word)), ("meta", other.logit(meta, none, none))):
                    for side in (1, -1):
                        have = best.get(f"{name}-{view}-{side}")
                        new = pd.DataFrame({"doc_id": own["doc_id"].array, "sure": side * z})
                        best[f"{name}-{view}-{side}"] = (new if have is None else pd.concat([have, new])).sort_values(["sure", "doc_id"], ascending=[False, True]).head(count)
        for list_, rows in best.items():
            yield rows.assign(list=list_)

    free = docs.where(F.col("doc_id").isNotNull()).join(F.broadcast(known.select("doc_id")), "doc_id", "left_anti")
    found = written(free.select("doc_id", "source", "lang", "declared", "t").mapInPandas(judged, f"doc_id {kind}, sure double, list string"), "surest")
    turn = Window.partitionBy("list").orderBy(F.desc("sure"), "doc_id")  # `count` rows from each task at most
    return found.withColumn("_n", F.row_number().over(turn)).where(F.col("_n") <= count).select("doc_id").distinct()


def fit_models(docs: DataFrame, labels: DataFrame, sample: int, count: int) -> dict[str, Model | None]:
    """Models of quality and toxicity from a bounded sample of docs (doc_id, t, source, lang, declared) and the surest other ones."""
    given = labels.select("doc_id", F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic")).where(F.col("doc_id").isNotNull())
    known = given.orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "toxic").limit(sample).groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    own = sample_of(docs, known)
    none = np.zeros(0, dtype=np.int64)
    first = {}
    for m in MODELS:
        parts = split(own.labels[m]) if own else None
        if parts is not None:
            rows, y = parts[0], (own.labels[m][parts[0]] == 1).astype(float)
            one = np.ones(len(rows))
            first[m] = (View.fit(own.dense[rows], *rows_of(*frequent(own.of, own.word), rows, len(own.dense)), y, one, 150), View.fit(own.meta[rows], none, none, y, one, 100))
    if not first:
        return dict.fromkeys(MODELS)
    pool = surest(docs, known, first, count).select("doc_id", F.lit(None).cast("int").alias("quality"), F.lit(None).cast("int").alias("toxic"))
    more = sample_of(docs, pool)
    if more is not None:
        n = len(own.dense)
        of, word = np.concatenate([own.of, more.of + np.int32(n)]), np.concatenate([own.word, more.word])
        own = Sample(np.concatenate([own.dense, more.dense]), np.concatenate([own.meta, more.meta]), of, word, {m: np.concatenate([own.labels[m], more.labels[m]]) for m in MODELS})
    own.of, own.word = frequent(own.of, own.word)
    return {m: cotrain(own.dense, own.meta, own.of, own.word, own.labels[m]) for m in MODELS}


def classify(docs: DataFrame, labels: DataFrame, sample: int = LABELLED, count: int = SUREST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: row (all its columns), quality and toxic (probabilities), kept.

    Null and empty texts are scored like any other, on empty features. source, lang and n_chars (the declared length)
    may be null or missing. Repeated rows are scored each for itself; an empty table gives an empty result. Without
    labels of both classes quality is 1 and toxicity 0 for all, so all are kept. Extra columns may
    have any names.
    """
    extra = [(F.col(c).try_cast(kind) if c in docs.columns else F.lit(None).cast(kind)).alias(name) for c, name, kind in (("source", "source", "string"), ("lang", "lang", "string"), ("n_chars", "declared", "double"))]
    small = small_batches(docs).select(F.col(id_col).alias("doc_id"), body(text_col).cast("binary").alias("t"), *extra)
    models = docs.sparkSession.sparkContext.broadcast(fit_models(small, labels, sample, count))
    none = np.zeros(0, dtype=np.int64)

    @F.pandas_udf("quality double, toxic double")
    def score(t: pd.Series, source: pd.Series, lang: pd.Series, declared: pd.Series) -> pd.DataFrame:
        out = []
        for part, data, starts, ends in slices([pd.DataFrame({"t": t, "source": source, "lang": lang, "declared": declared})]):
            of, word, dense, _ = text_features(data, starts, ends)
            meta = meta_features(part["source"], part["lang"], part["declared"])
            own = {}
            for name, default in (("quality", 1.0), ("toxic", 0.0)):
                m = models.value[name]
                own[name] = np.full(len(part), default) if m is None else m.probability(m.text.logit(dense, of, word), m.meta.logit(meta, none, none))
            out.append(pd.DataFrame(own))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"quality": [], "toxic": []}, dtype=float)

    rows = small_batches(docs).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), body(text_col).cast("binary").alias("t"), *extra)
    scored = rows.select("row", score("t", "source", "lang", "declared").alias("s"))
    return scored.select("row", "s.quality", "s.toxic").withColumn("kept", (F.col("quality") >= GOOD) & (F.col("toxic") < TOXIC))


def op10_quality_classifier(spark, sf_dir: str) -> DataFrame:
    from plumbline.llm.common import table

    out = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select(F.col("row.doc_id").alias("doc_id"), F.col("quality").alias("score"), F.col("toxic").alias("toxic_score"), "kept")
