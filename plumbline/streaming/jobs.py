"""Streaming forms of the longitudinal operators: windowed counts with a watermark, smoothing with kept state.

Both run until what is there is read (availableNow) and can be started again on their checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from plumbline.sources.records import fresh


def stream(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, a folder or a single file, as a stream of its files."""
    # As a pattern, for a plain path has to be a folder.
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[{path[-1]}]")


def drained(df: DataFrame, mode: str, tag: str) -> DataFrame:
    """Runs a stream to the end of its input; its batches, each written once under its number, as a table.

    A batch that is run again after a failure overwrites its own folder, so nothing is there twice.
    """
    spark, path = df.sparkSession, fresh(df.sparkSession, tag)

    def put(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    query = df.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", f"{path}-state").foreachBatch(put).start()
    query.awaitTermination()
    return spark.read.option("basePath", path).schema(df.schema).parquet(f"{path}/batch=*") if query.lastProgress else spark.createDataFrame([], df.schema)


def windowed_counts(events: DataFrame, time: str, keys: list[str], value: str, width: str = "7 days", late: str = "2 days") -> DataFrame:
    """Counts and sums by window and keys; rows later than `late` behind the newest one may be left out."""
    window = F.window(time, width)
    return events.withWatermark(time, late).groupBy(window, *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("start"), *keys, "n", "total")


def latest_of(updates: DataFrame, keys: list[str], growing: str) -> DataFrame:
    """Of all updates of a key the last one: that of the greatest `growing` number."""
    rest = [c for c in updates.columns if c not in keys]
    return updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), growing).alias("_last")).select(*keys, "_last.*")


def smoothed_stream(rows: DataFrame, key: str, period: str, value: str, lam: float) -> DataFrame:
    """Exponentially weighted means by key over growing periods: key, period, smooth.

    The state holds the last period and its mean; a period that was seen, or is older, changes nothing.
    """

    def step(name: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, mean = state.get if state.exists else (None, None)
        frame = pd.concat(list(batches)).sort_values(period)
        out = []
        for at, x in zip(frame[period], frame[value], strict=True):
            if pd.isna(x) or (last is not None and at <= last):
                continue
            mean = float(x) if mean is None else lam * float(x) + (1 - lam) * mean
            last = int(at)
            out.append((name[0], last, mean))
        if last is not None:
            state.update((last, mean))
        yield pd.DataFrame(out, columns=[key, period, "smooth"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, {period} long, smooth double", "last long, mean double", "append", GroupStateTimeout.NoTimeout)
