"""Known answers and properties of the ranking kernel."""

import math
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from plumbline.functions import text
from plumbline.functions.kernel import probit, tie_blocks, with_midrank
from plumbline.operators import entities, lists, scoring


def test_probit(spark):
    p = [1e-12, 1e-6, 0.01, 0.075, 0.3, 0.5, 0.77, 0.93, 0.999, 1 - 1e-9]
    got = spark.createDataFrame([(x,) for x in p], "p double").select("p", probit(F.col("p")).alias("z")).collect()
    for r in got:
        assert math.isclose(r["z"], NormalDist().inv_cdf(r["p"]), rel_tol=1e-9, abs_tol=1e-12)
    assert spark.createDataFrame([(0.0,), (1.0,)], "p double").select(probit(F.col("p")).alias("z")).dropna().count() == 0


def test_midrank_ties(spark):
    df = spark.createDataFrame([("s", 1.0), ("s", 2.0), ("s", 2.0), ("s", 3.0)], "s string, x double")
    got = sorted(r["p"] for r in with_midrank(df, ["s"], "x").collect())
    assert got == [0.125, 0.5, 0.5, 0.875]


def test_tie_blocks_over_many_stretches(spark):
    df = spark.range(5000).select(F.lit("a").alias("s"), F.floor(F.sqrt("id")).cast("double").alias("x"))
    got = {r["x"]: (r["lower"], r["here"], r["n"]) for r in tie_blocks(df, ["s"], "x").collect()}
    xs = sorted(math.isqrt(i) for i in range(5000))
    for x, (lower, here, n) in got.items():
        assert (lower, here, n) == (sum(v < x for v in xs), xs.count(int(x)), 5000)


@pytest.mark.parametrize(("basis", "jet"), [("median", 2.4844), ("others_mean", 2.5335)])
def test_worked_example(spark, basis, jet):
    """Three sources of weights 1, 0.75, 0.25; the whole weight 2."""
    t = [("jet", 1.0, 3.54), ("jet", 0.75, 2.70), ("jet", 0.25, 1.59), ("inter", 1.0, 2.99), ("inter", 0.75, 2.29), ("inter", 0.25, 1.77), ("mona", 1.0, 2.92), ("mona", 0.75, 1.77)]
    df = spark.createDataFrame(t, "family string, w double, z double")
    got = {r["family"]: round(r["score"], 4) for r in scoring.fused(scoring.guarded(df, ["family"], basis=basis), ["family"], "w", 2.0).collect()}
    assert got == {"jet": jet, "inter": 2.1458, "mona": 1.9756}


def test_rbo_of_equal_lists_is_one(spark):
    a = spark.createDataFrame([(i, i + 1) for i in range(20)], "id int, r int")
    assert math.isclose(lists.rank_biased_overlap(a, a, "id", "r").first()["rbo"], 1.0, abs_tol=1e-9)


def test_chains_drop_cycles(spark):
    hops = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "x")], "o string, n string")
    got = {(r["o"], r["end"], r["steps"]) for r in entities.chains(hops, "o", "n").collect()}
    assert got == {("a", "c", 2), ("b", "c", 1)}


def test_keys():
    assert text.match_key_of("ＦＩＲＡ  Code-Straße") == text.match_key_of("fira codestrasse")
    assert text.search_key_of("Éclair") == "eclair"
    for s in ("Ünï cödé", "ﬁ-x", "Ⅷ"):
        assert text.match_key_of(text.match_key_of(s)) == text.match_key_of(s)


def test_code_points(spark):
    df = spark.createDataFrame([("U+41, U+43-44",), ("u+4?",), ("U+110-",), (None,)], "r string").select(text.code_points(F.col("r")).alias("p"))
    got = [r["p"] for r in df.collect()]
    assert got[0] == [0x41, 0x43, 0x44] and got[1] == list(range(0x40, 0x50)) and got[2] is None and got[3] is None
