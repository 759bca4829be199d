"""Session set-up and table access shared by every query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", partitions: int = 8) -> SparkSession:
    """A local session with the settings tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("plumbline")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, read lazily through Spark so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
