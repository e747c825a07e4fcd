"""Records of CSV files whose quoted fields hold line breaks, read by as many tasks as the files have splits."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwright.session import scratch

_OUT = "file bigint, start bigint, place bigint, open boolean, begun boolean, value string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file and the byte at which their split begins; lines of a split come in order."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _cut(inside: dict[tuple[int, int], bool]):
    """A mapInArrow function over lines in the order of their split: a row per record, or part of one at an end of the split.

    ``inside`` says of each split whether it begins in a quoted field. ``begun`` is false for the part of a record that an earlier
    split began, ``open`` true for one that goes on in the next.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, held, quoted, begun, place = None, [], False, True, 0
        rows: list[tuple] = []

        def put(is_open: bool) -> None:
            nonlocal held, begun, place
            rows.append((*piece, place, is_open, begun, "\n".join(held)))
            held, begun, place = [], True, place + 1

        def table() -> pa.RecordBatch:
            names = ["file", "start", "place", "open", "begun", "value"]
            cols = [pa.array(c) for c in zip(*rows, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(cols, names=names)

        for batch in batches:
            for f, s, line in zip(*[batch.column(c).to_pylist() for c in ("file", "start", "value")], strict=True):
                if (f, s) != piece:
                    if held:
                        put(quoted)
                    piece, place = (f, s), 0
                    quoted = inside[piece]
                    begun = not quoted
                held.append(line)
                quoted ^= line.count('"') % 2 == 1
                if not quoted:
                    put(False)
            if rows:
                yield table()
        if held:
            put(quoted)
        if rows:
            yield table()

    return run


def records(spark: SparkSession, path: str) -> DataFrame:
    """``value``, one row per record of the files under ``path`` without each file's first, which is its header.

    A line begins a record if an even number of quotes stands before it in its file (quotes in a quoted field are doubled). A
    first pass counts the quotes of every split; the parity before a split is that of all splits before it, one row each. A second
    pass cuts the lines of each split into records where it reads them. Only records that go over the edge of a split are
    put together by a shuffle. Both passes run in a session that fixes the splits, whatever becomes of executors meanwhile; the result
    is written.
    """
    fixed = spark.newSession()
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        fixed.conf.set(name, spark.conf.get(name))
    fixed.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    lines = _lines(fixed, path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    odd = lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # a row per split, as many as the driver starts tasks
    known = odd.select("file", "start", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside")).collect()
    inside = {(r["file"], r["start"]): r["inside"] for r in known}
    out = scratch(spark, "records")
    lines.mapInArrow(_cut(inside), _OUT).write.parquet(out)
    rows = spark.read.schema(_OUT).parquet(out)
    at_edge = F.col("open") | ~F.col("begun")
    # what belongs together at the edges: a record is begun once, and goes on in the splits after that
    edges = rows.filter(at_edge).select("*", (F.col("begun")).cast("int").alias("_one"))
    number = Window.partitionBy("file").orderBy("start", "place").rowsBetween(Window.unboundedPreceding, 0)
    edges = edges.withColumn("_record", F.sum("_one").over(number))
    parts = F.array_sort(F.collect_list(F.struct("start", "place", "value")))
    joined = edges.groupBy("file", "_record").agg(parts.alias("parts"))
    joined = joined.select(
        "file", F.col("parts")[0]["start"].alias("start"), F.col("parts")[0]["place"].alias("place"),
        F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"),
    )
    whole = rows.filter(~at_edge).select("file", "start", "place", "value").unionByName(joined)
    body = whole.filter(~((F.col("start") == 0) & (F.col("place") == 0)))
    value = F.regexp_replace("value", "\r$", "")
    return body.select(value.alias("value")).filter(F.trim("value") != "")
