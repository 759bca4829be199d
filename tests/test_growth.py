"""Steps whose work once grew faster than their input, and results that only larger tables reach."""

import duckdb
import numpy as np
from pyspark.sql import functions as F

from plumbline.functions import text
from plumbline.operators import licences, measure, model, owned
from plumbline.queries import ORACLES, QUERIES
from plumbline.sources import records


def test_many_codes_of_one_name_count_once(spark):
    # Each entry met every code row of its name: here 25,000 by 20,000, and a row by family for each entry again.
    n, codes_of = 25_000, 20_000
    tries = spark.range(n).select(F.col("id").alias("entry"), F.lit(1).alias("place"), F.lit("ring").alias("name"), (F.col("id") % 2 == 0).alias("trusted"), owned.chain(F.lit("ring"), F.lower).alias("chain"))
    codes = spark.range(codes_of).select(F.lit("ring").alias("key"), F.concat(F.lit("f"), (F.col("id") % 3).cast("string")).alias("family"), F.when(F.col("id") % 3 == 0, "f").otherwise("l").alias("letter"), F.lit(False).alias("known"), F.lit(None).cast("string").alias("reason"))
    doubts = spark.createDataFrame([("ring", "f9")], "key string, family string")
    got = owned.outcomes(tries, codes, doubts).groupBy("outcome", "family", "why").count().collect()
    assert {tuple(r) for r in got} == {("owned", "f0", "family", n // 2), ("near", "f0", "ambiguous", n // 2), ("near", "f1", "related", n), ("near", "f2", "related", n), ("near", "f9", "ambiguous", n // 2)}
    best = owned.families(tries, codes, doubts)
    assert {tuple(r) for r in best.select("family", "outcome", "why").collect()} == {("f0", "owned", "family"), ("f1", "near", "related"), ("f2", "near", "related"), ("f9", "near", "ambiguous")}
    assert sorted(map(tuple, best.collect())) == sorted(map(tuple, owned.by_family(owned.outcomes(tries, codes, doubts)).collect()))


def test_equal_fonts_are_integrated_once_and_dealt_out(spark):
    model = measure.Model((measure.Term("a"), measure.Term("b")))
    counts = spark.range(600).select("id", F.explode(F.array(F.struct(F.lit("a").alias("term"), (F.col("id") % 3).alias("y")), F.struct(F.lit("b").alias("term"), (F.col("id") % 2 * 40).alias("y")))).alias("x")).select("id", "x.*")
    fonts = measure.Fonts.of(counts, model)
    assert fonts.table.count() == 600 and len(fonts.table.inputFiles()) > 1  # one task worked on all before
    merged = fonts.merged()
    assert sorted(r["times"] for r in merged.table.collect()) == [100.0] * 6
    theta = np.array([-1.0, 0.5, 0.1, 0.7, -2.0, 1.5, 0.3, 0.2])
    for found, want in zip(merged.objective([theta, theta + 0.1]), fonts.objective([theta, theta + 0.1])):
        assert np.allclose(found, want, rtol=1e-10)
    x, w = measure.grid()
    rows = [measure.Rows(*(np.array(z, float) for z in ([3, 3, 5], [3, 9, 5], [[1.0]] * 3, [1, 1, 1])), np.array([0, 1, 1]))]
    total, _ = measure.Batch(None, rows, 2, np.ones(2)).weights(measure.Model((measure.Term("a"),)), theta[:4], x, w)
    own = measure.loglik(measure.Term("a"), theta[:4], rows[0], x)
    assert np.allclose(total, [w + own[0], w + own[1] + own[2]], rtol=1e-12)


def against_sql(spark, folder, name, **tables):
    """A query's rows on small tables of one's own, and those of its SQL."""
    con = duckdb.connect()
    for t, df in tables.items():
        df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{t}.parquet")
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet/*.parquet')")
    got = QUERIES[name](spark, str(folder))
    want = con.execute(f"select {', '.join(got.columns)} from ({ORACLES[name]})").fetchall()
    plain = lambda rows: sorted((tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in rows), key=repr)
    assert want and plain(got.collect()) == plain(want)


def test_suppliers_and_parts_of_one_number(spark, tmp_path):
    # Part 1,000,001 and supplier 1 had one number, and each other's installs.
    lines = [(1, 1_000_001, 1, 9.0), (2, 1_000_001, 2, 4.0), (3, 7, 1, 2.0), (4, 8, 1, 30.0), (5, 8, 2, 1.0)]
    parts = [(1_000_001, "a"), (7, "a"), (8, "b")]
    against_sql(spark, tmp_path, "dependency_share", lineitem=spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double"), part=spark.createDataFrame(parts, "p_partkey long, p_brand string"))


def test_histories_that_begin_with_nothing(spark, tmp_path):
    weeks = {1: "2024-01-02", 2: "2024-01-09", 3: "2024-01-16"}
    values = {("view", 1): {2: 0.0, 3: 5.0}, ("view", 2): {1: 0.0, 3: 1.0}, ("view", 3): {1: 2.0}, ("view", 4): {1: 1.0, 2: 1.0, 3: 0.0}, ("view", 5): {3: 0.0}, ("error", 1): {1: 0.0, 2: 3.0}, ("error", 2): {1: 1.0, 3: 9.0}}
    rows = [(s, f, weeks[w], x) for (s, f), own in values.items() for w, x in own.items()]
    events = spark.createDataFrame(rows, "event_type string, user_id long, ts string, value double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    against_sql(spark, tmp_path, "share_history", events=events)


def test_small_rows_of_much_work_are_dealt_out(spark):
    # One task had them all: their bytes are few.
    terms = spark.range(50).select("id", F.lit("t").alias("term"), *[F.lit(v).alias(c) for c, v in (("y", 2.0), ("n", 1.0), ("e", 1.0), ("alpha", 0.5), ("lam", 0.8), ("bulk", 0.1), ("k", 2.0))])
    for out in (model.posterior(terms, ["id"], (0.05,)), model.information_shares(terms, ["id"])):
        assert out.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    assert QUERIES["license_print"](spark, "/root/testdata/sf0.001").select(F.spark_partition_id().alias("p")).distinct().count() > 1
    points = spark.range(4000).select((F.col("id") % 100).alias("k"), (F.col("id") * 7 % 500).alias("p")).repartition(6)
    assert text.runs(points, "k", "p").select(F.spark_partition_id().alias("p")).distinct().count() > 6


def test_parts_of_long_expressions_stand_in_them_once(spark):
    size = lambda c: len(str(c))
    assert size(records.version_key(F.col("v"))) < 3_000
    assert size(licences.text_print(F.col("v"))) < 20_000
