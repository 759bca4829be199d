"""What the text operators share: table access, lineage cuts, hot keys, row keys."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the data folder; any store that Spark reads will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a local one of this process where that is unset."""
    return (spark.conf.get("spark.checkpoint.dir", None) or local_dir()).rstrip("/")


@lru_cache(maxsize=1)
def local_dir() -> str:
    """Stands in for the shared folder on a single machine, where the session names none (tests)."""
    return "file://" + tempfile.mkdtemp(prefix="plumbline-")


#: Rows that go to a Python worker at once, so that long texts don't fill its memory.
BATCH_ROWS = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """df, in whose session workers get BATCH_ROWS rows at once at most (the setting is read when df runs, so it stays)."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


#: Spark removes the shuffle files of an execution at its end while this is set.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, tag: str) -> DataFrame:
    """df written once as Parquet in the shared folder and read again.

    This cuts the lineage: a lost executor costs a re-read of the written files, not the work
    before them. The schema is given on reading, so an empty table keeps its columns. Shuffle files
    of the write are of no more use after it, so Spark is asked to remove them, for this write alone.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/plumbline/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def done(*tables: DataFrame) -> None:
    """Empties written tables that nothing reads any more: what was made of them is written itself."""
    for t in tables:
        t.limit(0).write.mode("overwrite").parquet(t.written_to)


def body(text_col: str) -> Column:
    """The text, an empty one for null."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


#: Rows from which a key may be hot, the most hot keys there can be, and into how many parts one is dealt at most.
HOT_ROWS, HOT_KEYS, SALTS = 500, 4096, 64


def dealt(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner", sizes: DataFrame | None = None) -> DataFrame:
    """rows joined with table (keys, n: how many rows each key has, and more) by keys, hot keys dealt out in parts.

    A key is hot with over HOT_ROWS rows and over 1/HOT_KEYS of all, so at most HOT_KEYS keys are hot;
    they are broadcast to mark their rows, which are dealt out at random. A key gets as many parts as
    this bound goes into its rows (SALTS at most), and table has its rows once for each part. sizes
    (keys, n; table itself if it is written) is read to find the hot keys, so it is to be a written table.
    """
    sizes = table if sizes is None else sizes
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    least = max(HOT_ROWS, total // HOT_KEYS)
    parts = F.least(F.lit(SALTS), F.ceil(F.col("n") / least)).cast("int")
    marks = sizes.where(F.col("n") > least).select(*keys, parts.alias("_parts")).distinct()  # HOT_KEYS rows at most
    rows = rows.join(F.broadcast(marks), keys, "left")
    rows = rows.withColumn("_salt", F.floor(F.rand(7) * F.coalesce("_parts", F.lit(1))).cast("int")).drop("_parts")
    copies = F.when(F.col("n") > least, F.sequence(F.lit(0), parts - 1)).otherwise(F.array(F.lit(0)))
    return rows.join(table.withColumn("_salt", F.explode(copies)).drop("n"), [*keys, "_salt"], how).drop("_salt")


def numbered(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """df with a unique key k that goes up with the id (null first), and with the text among rows of one id.

    Unique integer ids are the key themselves. Else rows are sorted, written, and numbered by their
    place in their part and the sizes of the parts before, so that a lost executor doesn't change numbers.
    """
    df = small_batches(df)
    whole = df.schema[id_col].dataType.typeName() in ("byte", "short", "integer", "long")
    if whole:
        ids = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
        whole = not ids.where((F.col("n") > 1) | F.col(id_col).isNull()).take(1)
    if whole:
        return df.withColumn("k", F.col(id_col).cast("long"))
    ordered = df.orderBy(F.col(id_col).asc_nulls_first(), text_col)
    ordered = written(ordered.withColumn("_part", F.spark_partition_id()).withColumn("_in", F.monotonically_increasing_id()), "numbered")
    sizes = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row for each part
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return ordered.join(F.broadcast(sizes), "_part").withColumn("k", F.col("_before") + F.col("_in").bitwiseAND((1 << 33) - 1)).drop("_part", "_in", "_before")
