"""Quality rules: decision lists learned from labelled statistics by sequential covering.

Each rule is a conjunction of thresholds on a text's statistics that rejects it. A rule grows by the
condition of highest information gain until it covers no good text of the growing part, and is then
pruned from its end as long as that serves the part held back. What a rule covers is taken out
before the next one grows. The list becomes one ordered Spark conditional expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import body, small_batches
from plumbline.llm.repeats import slices
from plumbline.llm.text_stats import COUNTS, SHARES, statistics

#: Labelled texts that the rules are learned from, at most: those of the least hashes of their ids.
SAMPLE = 5000
#: Rules in a list, conditions in a rule, thresholds tried on a statistic.
RULES, CONDITIONS, CUTS = 12, 4, 48
#: Precision that a rule must have on the part held back.
PRECISION = 0.95


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    threshold: float

    def column(self) -> Column:
        return F.col(self.name) >= self.threshold if self.above else F.col(self.name) < self.threshold

    def holds(self, x: pd.DataFrame) -> np.ndarray:
        v = x[self.name].to_numpy()
        return v >= self.threshold if self.above else v < self.threshold


def covers(rule: list[Condition], x: pd.DataFrame) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for c in rule:
        out &= c.holds(x)
    return out


def between(c: Condition, x: pd.DataFrame) -> Condition:
    """The condition with its threshold halfway to the next value on the other side; it holds for the same rows of x."""
    v = x[c.name].to_numpy()
    below, above = v[v < c.threshold], v[v >= c.threshold]
    if not len(below) or not len(above):
        return c
    low, high = float(below.max()), float(above.min())
    middle = (low + high) / 2
    return Condition(c.name, c.above, middle) if low < middle <= high else c


def grow(x: pd.DataFrame, bad: np.ndarray) -> list[Condition]:
    rule: list[Condition] = []
    inside = np.ones(len(x), dtype=bool)
    while len(rule) < CONDITIONS:
        p0, n0 = int((inside & bad).sum()), int((inside & ~bad).sum())
        if not p0 or not n0:
            break
        best = (1e-9, None)
        for name in x.columns:
            v = x[name].to_numpy()
            for cut in np.unique(np.quantile(v[inside & bad], np.linspace(0, 1, CUTS))):
                for above in (True, False):
                    hit = inside & ((v >= cut) if above else (v < cut))
                    p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
                    if p:
                        gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
                        if gain > best[0]:
                            best = (gain, Condition(name, above, float(cut)))
        if best[1] is None:
            break
        rule.append(between(best[1], x[inside]))
        inside &= rule[-1].holds(x)
    return rule


def prune(rule: list[Condition], x: pd.DataFrame, bad: np.ndarray) -> list[Condition]:
    def worth(r: list[Condition]) -> float:
        hit = covers(r, x)
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        return (p - n) / (p + n) if p + n else -1.0

    while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
        rule = rule[:-1]
    return rule


def learn(x: pd.DataFrame, bad: np.ndarray, seed: int = 11) -> list[list[Condition]]:
    """Ordered rules, each of which rejects what it covers."""
    held = np.random.default_rng(seed).random(len(x)) < 1 / 3
    rules: list[list[Condition]] = []
    left = np.ones(len(x), dtype=bool)
    while len(rules) < RULES and (left & bad & ~held).sum() >= 3:
        rule = grow(x[left & ~held], bad[left & ~held])
        if not rule:
            break
        rule = prune(rule, x[left & held], bad[left & held])
        hit = covers(rule, x) & left
        p, n = int((hit & bad & held).sum()), int((hit & ~bad & held).sum())
        if not (hit & bad).sum() or p + n == 0 or p / (p + n) < PRECISION:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def verdict(rules: list[list[Condition]]) -> Column:
    """Whether a text is kept: the first rule that covers it rejects it."""
    out = None
    for rule in rules:
        both = rule[0].column()
        for c in rule[1:]:
            both = both & c.column()
        out = F.when(both, False) if out is None else out.when(both, False)
    return F.lit(True) if out is None else out.otherwise(True)


def with_statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id and COUNTS of each row, and their shares."""
    rows = docs.select(F.col(id_col).alias("doc_id"), body(text_col).cast("binary").alias("t"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for own, data, starts, ends in slices(batches):
            yield pd.DataFrame({"doc_id": own["doc_id"].array, **statistics(data, starts, ends).counts})

    out = rows.mapInPandas(counts, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS))
    return out.select("*", *[F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0).alias(name) for name, a, b in SHARES])


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, sample: int) -> DataFrame:
    """Rows of docs with their label, of a bounded sample of labels (the least hashes of ids)."""
    some = labels.select(F.col("doc_id").alias(id_col), F.col("quality").alias("_quality"), F.col("toxic").alias("_toxic")).where(F.col(id_col).isNotNull() & F.col("_quality").isNotNull())
    some = some.orderBy(F.xxhash64(id_col), id_col, "_quality").limit(sample).dropDuplicates([id_col])
    return docs.join(F.broadcast(some), id_col)  # `sample` rows at most


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, the base counts, base_failed and kept, with all other statistics.

    base_failed: under 50 words, or over half of them in repeated 3-word windows. kept is false if
    base_failed, else the learned list's verdict; without usable labels the list is empty and keeps.
    Null and empty texts have no words, and fail. Repeated rows are judged each for itself; an empty
    table gives an empty result; other columns are not looked at.
    """
    # Lengths tell languages apart rather than good from bad, so the rules do without them.
    names = [name for name, _, _ in SHARES if name != "word_length"]
    own = small_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    known = labelled(own, labels, "doc_id", sample)
    known = with_statistics(known, "doc_id", "text").join(known.select("doc_id", "_quality"), "doc_id").dropDuplicates(["doc_id"])
    table = known.select("doc_id", *names, "_quality").toPandas().sort_values("doc_id", ignore_index=True)
    rules = learn(table[names], (table["_quality"] == 0).to_numpy()) if len(table) else []
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = with_statistics(own, "doc_id", "text").withColumn("base_failed", failed)
    return out.withColumn("kept", F.when(F.col("base_failed"), False).otherwise(verdict(rules)))


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    from plumbline.llm.common import table

    out = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
