"""Each stage of the pipeline, and all of them, on odd rows: nulls, repeated ids, clashing columns, empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P

PROSE = " ".join(f"word{k % 61} of the {k}" for k in range(90))
ITEM = "a benchmark item that has some twelve words and is found anywhere"
ROWS = [(1, PROSE), (1, PROSE + " end"), (2, None), (None, ITEM + " " + PROSE[:200]), (None, "a clean row without an id, and with words of its own: " + " ".join(f"n{k}" for k in range(40))), (3, ""), (4, "short"), (4, "short"), (5, "prefix of its own here " + PROSE)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('pipeline')}"
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").select("*", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"), F.lit("x").alias("k"), F.lit(1).alias("row"))
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(9, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def kept(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def test_stages_keep_columns_and_rows_of_their_own(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = {name: stage(spark, docs, folder) for name, stage in P.STAGES}
    for name, _ in P.STAGES[:-1]:
        assert out[name].columns == docs.columns
    assert kept(out["quality_classifier"]) == sorted(ROWS, key=repr)
    gone = [(1, PROSE + " end"), (4, "short"), (5, "prefix of its own here " + PROSE)]
    assert kept(out["minhash_near_dedup"]) == sorted([r for k, r in enumerate(ROWS) if r not in gone or k == 6], key=repr)
    left = kept(out["suffix_array_dedup"])
    assert len(left) == len(ROWS) and (2, None) in left
    # "here" goes too: the row without an id comes first, and its "anywhere word0 ..." holds the same 100 bytes.
    assert [t.strip() for k, t in left if k == 5] == ["prefix of its own"]
    clean = [r for r in ROWS if not (r[1] or "").startswith(ITEM)]
    assert kept(out["benchmark_decontamination"]) == sorted(clean, key=repr)
    pieces = out["best_fit_packing"].collect()
    assert len(pieces) == len(ROWS) and max(r["offset"] + r["length"] for r in pieces) <= 4096


def test_empty_tables_stay_empty(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_run(spark, folder):
    out = P.run(spark, folder).collect()
    assert {r["doc_id"] for r in out} == {1, 2, 3, 4, None} and len({(r["sequence_id"], r["offset"]) for r in out}) == len(out)
