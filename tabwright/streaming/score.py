"""Streams: stateless scoring and windowed usage counts.

Fitted state is frozen in the saved pipeline, so scoring a stream is a plain
transformation. Every batch goes to its own folder and replaces it when the
batch is run again, which makes a restarted query write each row once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabwright.functions.scalar import as_instant, as_wall_clock


def table_stream(spark: SparkSession, folder: str, glob: str | None = None, schema=None, files_per_batch: int | None = None) -> DataFrame:
    """The Parquet files of a folder as a stream, as they arrive; ``glob`` picks files by name."""
    source = spark.read if glob is None else spark.read.option("pathGlobFilter", glob)
    reader = spark.readStream.schema(schema or source.parquet(folder).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(folder)


def write_batches(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Write each micro-batch under ``out/batch=N`` and stop when the input is used up."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(put)
        .start()
    )


def score_stream(stream: DataFrame, scorer: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Score request records as they arrive; ``scorer`` works row by row."""
    return write_batches(scorer(stream), out, checkpoint)


def usage_windows(stream: DataFrame, ts: str, keys: list[str], window: str = "1 day", late: str = "2 days", slide: str | None = None) -> DataFrame:
    """Event counts and value sums per key and time window, late rows up to ``late``."""
    plain = dict(stream.dtypes)[ts] == "timestamp_ntz"  # event time must be an instant
    timed = (stream.withColumn(ts, as_instant(ts)) if plain else stream).withWatermark(ts, late)
    w = F.window(ts, window, slide) if slide else F.window(ts, window)
    g = timed.groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    start = as_wall_clock("w.start") if plain else F.col("w.start")
    return g.select(start.alias("start"), *keys, "n", "total")


def latest_state(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """The last written row per key of an update-mode stream."""
    rows = spark.read.parquet(out)
    rest = [c for c in rows.columns if c not in keys and c != "batch"]
    best = F.max_by(F.struct(*rest), "batch").alias("_b")
    return rows.groupBy(*keys).agg(best).select(*keys, "_b.*")
