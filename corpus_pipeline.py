"""From raw documents to packed sequences, in five stages of text operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents. run() hands one stage's rows to the next one as written tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import table, written
from plumbline.llm.cotraining import classify
from plumbline.llm.neardup import near_duplicates
from plumbline.llm.packing import pack
from plumbline.llm.repeats import remove_repeats
from plumbline.llm.tiling import held, with_keys


def _columns(docs: DataFrame, row: str = "row") -> list:
    return [F.col(f"{row}.`{c}`").alias(c) for c in docs.columns]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps.

    Null and empty texts are judged like any other; repeated rows each for itself; an empty table stays one.
    """
    return classify(docs, table(spark, sf_dir, "labels")).where("kept").select(*_columns(docs))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates (five words, similarity 0.8).

    Null, empty and blank texts are like nothing and stay; of rows of one id, in the order of their texts,
    those that are like no earlier one stay as well.
    """
    return near_duplicates(docs).where("k = first").select(*_columns(docs))


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without what an earlier one (or an earlier place) has in 100 bytes or more.

    Null texts stay null; a text of which nothing is left is empty; n_chars, where there is one, follows.
    """
    out = remove_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Rows are told apart by a key of their own, so clean rows that share an id (or have none) stay.
    """
    base = with_keys(docs)
    gone = held(base, table(spark, sf_dir, "benchmark")).select("k").distinct()
    return base.join(gone, "k", "left_anti").select(*_columns(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens; null and empty texts are one piece of the end id."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can express neither the classifier nor the minimum of sequences.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written before the next one reads them."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
