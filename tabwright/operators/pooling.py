"""Isotonic pooling of a table of any size: neighbouring chunks of blocks are pooled in rounds until none falls."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.session import bucket_target, settle

#: Blocks that a chunk holds, and chunks that one round pools in one task.
CHUNK, FAN = 4096, 16
#: Ranges that lines and rows are cut into where they are joined.
RANGES = 1 << 14

_BLOCKS = "chunk bigint, at int, lo double, hi double, w double, s double"


def pool(lo: np.ndarray, hi: np.ndarray, w: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, ...]:
    """Blocks in order, pooled until their means rise; ``w`` is a block's weight and ``s`` its weighted sum."""
    first, weight, total = [], [], []
    for i, (x, y) in enumerate(zip(w.tolist(), s.tolist(), strict=True)):
        at = i
        while weight and total[-1] * x > y * weight[-1]:
            at, x, y = first.pop(), x + weight.pop(), y + total.pop()
        first.append(at)
        weight.append(x)
        total.append(y)
    start = np.array(first, np.int64)
    last = np.append(start[1:], len(lo)) - 1 if len(start) else start
    return lo[start], hi[last], np.array(weight), np.array(total)


def _table(parts: tuple[np.ndarray, ...], chunks: np.ndarray) -> pa.RecordBatch:
    lo, hi, w, s = parts
    at = np.arange(len(lo), dtype=np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(chunks[at // CHUNK]), pa.array((at % CHUNK).astype(np.int32)), pa.array(lo), pa.array(hi), pa.array(w), pa.array(s)],
        names=["chunk", "at", "lo", "hi", "w", "s"],
    )


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of one range of scores. A batch is pooled with what is left of those before it; all but the last CHUNK blocks,
    which later rows rarely reach, go out, and the rounds mend what they do reach."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    held = tuple(np.zeros(0) for _ in range(4))
    for batch in batches:
        cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("x", "x", "w", "s")]
        held = pool(*[np.append(a, b) for a, b in zip(held, cols, strict=True)])
        n = len(held[0]) // CHUNK - 1
        if n > 0:
            yield _table(tuple(a[: n * CHUNK] for a in held), number + np.arange(n))
            held = tuple(a[n * CHUNK :] for a in held)
            number += n
    if len(held[0]):
        yield _table(held, number + np.arange(-(-len(held[0]) // CHUNK)))


def _merge(table: pa.Table) -> pa.Table:
    """One round's chunks that lie side by side; what they become is no longer than they were and keeps their names."""
    table = table.sort_by([("chunk", "ascending"), ("at", "ascending")])
    names = np.unique(table.column("chunk").to_numpy())
    blocks = pool(*[table.column(c).to_numpy() for c in ("lo", "hi", "w", "s")])
    return pa.Table.from_batches([_table(blocks, names)])


def isotonic_blocks(counts: DataFrame) -> DataFrame:
    """Blocks ``(lo, hi, w, value)`` of the non-decreasing fit to ``(x, w, s)``: one row per score, its weight and weighted sum.

    Scores are cut into ranges and pooled in each. Pooling is associative, so the rest is to pool blocks that
    lie beside each other: a round finds the neighbouring chunks whose means fall, pools up to FAN of them in a
    task and leaves all others where they are; rounds go on until none falls. The order of chunks is looked
    at by one row per chunk. No list of blocks is ever whole in a task or on the driver.
    """
    counts = settle(counts.select("x", "w", "s"), "scores")
    n = bucket_target(counts.sparkSession, counts.count())
    blocks = settle(counts.repartitionByRange(n, "x").sortWithinPartitions("x").mapInArrow(_local, _BLOCKS), "blocks")
    while True:
        mean = F.col("s") / F.col("w")
        ends = blocks.groupBy("chunk").agg(F.min_by(mean, "at").alias("first"), F.max_by(mean, "at").alias("last"))
        order = Window.orderBy("chunk")  # one row per chunk
        rises = F.coalesce(F.lag("last").over(order) <= F.col("first"), F.lit(True))
        runs = ends.select("chunk", rises.cast("int").alias("_new")).withColumn("_run", F.sum("_new").over(order))
        inside = F.floor((F.row_number().over(Window.partitionBy("_run").orderBy("chunk")) - 1) / FAN)
        groups = runs.withColumn("_part", inside).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("_run", "_part")))
        groups = settle(groups.filter("_n > 1").select("chunk", "_run", "_part"), "falling")
        if groups.isEmpty():
            break
        moved = blocks.join(groups, "chunk").groupBy("_run", "_part").applyInArrow(_merge, _BLOCKS)
        blocks = settle(blocks.join(groups, "chunk", "left_anti").unionByName(moved), "blocks")
    return blocks.select("chunk", "at", "lo", "hi", "w", (F.col("s") / F.col("w")).alias("value"))


def lines(blocks: DataFrame) -> DataFrame:
    """``(x0, x1, y0, y1)``: the straight lines of the fit, level in a block and sloped from one block to the next."""
    here = F.struct(F.col("lo").alias("x"), F.col("value").alias("y"))
    inside = F.lead(here).over(Window.partitionBy("chunk").orderBy("at"))
    heads = blocks.groupBy("chunk").agg(F.min_by(here, "at").alias("_head"))
    heads = heads.select("chunk", F.lead("_head").over(Window.orderBy("chunk")).alias("_after"))  # one row per chunk
    both = blocks.withColumn("_next", inside).join(heads, "chunk").withColumn("_to", F.coalesce("_next", "_after"))

    def line(x0, x1, y0, y1):
        return F.struct(x0.alias("x0"), x1.alias("x1"), y0.alias("y0"), y1.alias("y1"))

    level = F.when(F.col("lo") < F.col("hi"), line(F.col("lo"), F.col("hi"), F.col("value"), F.col("value")))
    slope = F.when(F.col("_to").isNotNull(), line(F.col("hi"), F.col("_to.x"), F.col("value"), F.col("_to.y")))
    return both.select(F.inline(F.filter(F.array(level, slope), lambda x: x.isNotNull())))


def interpolate(df: DataFrame, fit: DataFrame, x: str, out: str) -> DataFrame:
    """``df`` with the value at ``x`` on ``lines``; beyond their ends that of the end. NULL and NaN give NULL.

    Lines and rows are cut into the same ranges, so that a row meets only the lines of its range.
    """
    edge = fit.approxQuantile("x0", [i / RANGES for i in range(1, RANGES)], 0.25 / RANGES)
    edges = [float("-inf"), *sorted(set(edge)), float("inf")]
    low, high = fit.agg(F.min(F.struct("x0", "y0")), F.max(F.struct("x1", "y1"))).first()
    both = Bucketizer(splitsArray=[edges, edges], inputCols=["x0", "x1"], outputCols=["_a", "_b"]).transform(fit)
    spread = both.select("x0", "x1", "y0", "y1", F.explode(F.sequence(F.col("_a").cast("int"), F.col("_b").cast("int"))).alias("_near"))
    v = F.col(x).cast("double")
    held = F.greatest(F.least(v, F.lit(high["x1"])), F.lit(low["x0"]))
    rows = df.withColumn("_x", F.when(v.isNotNull() & ~F.isnan(v), held))
    rows = Bucketizer(splits=edges, inputCol="_x", outputCol="_at", handleInvalid="keep").transform(rows)
    end = F.when(F.col("_x") == high["x1"], F.lit(high["y1"]))
    rows = rows.withColumn("_end", end).withColumn("_near", F.when(F.col("_x").isNotNull() & F.col("_end").isNull(), F.col("_at").cast("int")))
    rows = rows.drop("_at")
    on = (rows["_near"] == spread["_near"]) & (rows["_x"] >= spread["x0"]) & (rows["_x"] < spread["x1"])
    value = F.col("y0") + (F.col("y1") - F.col("y0")) * (F.col("_x") - F.col("x0")) / (F.col("x1") - F.col("x0"))
    return rows.join(spread, on, "left").select(*[rows[c] for c in df.columns if c != out], F.coalesce("_end", value).alias(out))
