"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabwright.session import settle

#: Rows that one sender partition, and one stretch of a shard, should hold.
PART_ROWS, STRETCH_ROWS = 50_000, 4_000
#: Sender partitions at most; beyond, they get longer. Bounds the matrix and the table of cuts.
MAX_PARTS = 4096


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` rows, taken without replacement, are among the ``good`` ones.

    By inversion over the ratios of neighbouring probabilities, outward from the mode; what
    lies beyond 40 standard deviations is left out. Works for any number of rows.
    """
    total = good + bad
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (total + 2)))
    sd = math.sqrt(draws * (good / total) * (bad / total) * (total - draws) / max(1, total - 1))
    reach = int(40 * sd) + 40
    a, b = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(a, b, dtype=np.float64)
    steps = np.log((good - k) * (draws - k)) - np.log((k + 1) * (bad - draws + k + 1))
    logp = np.concatenate([[0.0], np.cumsum(steps)])
    p = np.exp(logp - logp.max())
    return a + int(np.searchsorted(np.cumsum(p), rng.random() * p.sum(), "right").clip(0, b - a))


def matrix(rows: list[int], columns: list[int], seed: int) -> np.ndarray:
    """Rows that each partition sends to each shard, if all rows are shuffled uniformly.

    Row sums are ``rows`` and column sums ``columns``.
    """
    left, out = list(columns), np.zeros((len(rows), len(columns)), np.int64)
    for i, n in enumerate(rows):
        rng, rest = np.random.Generator(np.random.Philox(key=[seed, i])), sum(left)
        for j, good in enumerate(left[:-1]):
            got = hypergeometric(rng, good, rest - good, n) if n else 0
            out[i, j], n, rest, left[j] = got, n - got, rest - good, good - got
        out[i, -1], left[-1] = n, left[-1] - n
    return out


def _keyed(seed: int, purpose: int, *cols: str) -> Column:
    return F.xxhash64(F.lit(seed), F.lit(purpose), *cols)


def shuffle(docs: DataFrame, shards: int = 24, seed: int = 1, key: str = "doc_id", part_rows: int = PART_ROWS) -> DataFrame:
    """All rows and columns of ``docs`` with their ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard).

    Every assignment of rows to places is equally likely, and shard sizes differ by one
    at most. Rows belong to sender partitions by a hash of the key. The matrix says how
    many rows each partition sends to each shard; a partition's random order is cut
    accordingly, so that a row finds its shard by comparing its random number with the
    cuts. Rows move once, to their shard, and are permuted again there.

    The first passes read only the key. Rows with the same key, or the same random
    number, that a cut parts are counted off by their content. Columns named shard or
    slot in ``docs`` are replaced. A null key is a key like others; an empty table gives none.
    """
    docs = docs.drop("shard", "slot")
    spark = docs.sparkSession
    total = docs.count()
    parts = max(1, min(MAX_PARTS, math.ceil(total / part_rows)))
    place = lambda df: df.withColumn("_part", F.pmod(_keyed(seed, 0, key), F.lit(parts)).cast("int")).withColumn("_rand", _keyed(seed, 1, key))
    keys = settle(place(docs.select(key)).select("_part", "_rand", _keyed(seed, 2, key).alias("_again")), "keys")
    counts = {r["_part"]: r["n"] for r in keys.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = [total // shards + (i < total % shards) for i in range(shards)]
    sent = matrix([counts.get(p, 0) for p in range(parts)], sizes, seed)
    ends = [[int(x) for x in row[:-1]] for row in np.cumsum(sent, axis=1)]
    table = F.broadcast(spark.createDataFrame(list(enumerate(ends)), "_part int, _ends array<bigint>"))

    # the random number at which each shard begins in each partition
    ranked = keys.withColumn("_rank", F.row_number().over(Window.partitionBy("_part").orderBy("_rand")).cast("bigint") - 1)
    at = ranked.join(table, "_part").filter(F.array_contains("_ends", F.col("_rank")))
    starts = settle(at.select("_part", "_rank", F.col("_rand").alias("_cut")), "cuts")
    by_rank = starts.groupBy("_part").agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_cut"))).alias("_of"))
    cuts = settle(table.join(by_rank, "_part", "left").select("_part", F.transform("_ends", lambda e: F.col("_of")[e]).alias("_cuts"), "_ends"), "cuts")
    # a shard that begins at or after the partition's end has no cut, and no row reaches it
    ties = settle(
        keys.join(starts.distinct(), (keys["_part"] == starts["_part"]) & (keys["_rand"] == starts["_cut"]), "left_semi")
        .groupBy("_part", "_rand").agg(F.count(F.lit(1)).alias("k")).filter("k > 1"), "ties"
    )
    by_cut = F.aggregate("_cuts", F.lit(0), lambda n, c: n + F.when(F.col("_rand") >= c, 1).otherwise(0))
    placed = lambda df: df.join(F.broadcast(cuts), "_part").withColumn("shard", by_cut)

    def split(df: DataFrame, parted: DataFrame, order: list[Column]) -> DataFrame:
        """Rows of a random number that a cut parts, counted off one by one."""
        hit = df.join(parted, ["_part", "_rand"])
        rank = F.row_number().over(Window.partitionBy("_part", "_rand").orderBy(*order)).cast("bigint") - 1 + F.col("_below")
        hit = hit.withColumn("_rank", rank).join(F.broadcast(cuts), "_part")
        shard = F.aggregate("_ends", F.lit(0), lambda n, e: n + F.when(F.col("_rank") >= e, 1).otherwise(0))
        return hit.withColumn("shard", shard).drop("_below", "_rank", "_ends", "_cuts")

    moved, moved_keys = place(docs).withColumn("_again", _keyed(seed, 2, key)), keys
    if ties.isEmpty():
        moved, moved_keys = (placed(x).drop("_cuts", "_ends") for x in (moved, moved_keys))
    else:
        below = ranked.join(ties.select("_part", "_rand"), ["_part", "_rand"]).groupBy("_part", "_rand").agg(F.min("_rank").alias("_below"))
        parted = settle(below, "ties")
        content = [F.xxhash64(*[F.col(c).cast("string") for c in docs.columns]), *[F.col(c).cast("string") for c in docs.columns]]
        rest = lambda df: placed(df.join(parted, ["_part", "_rand"], "left_anti")).drop("_cuts", "_ends")
        moved, moved_keys = (
            rest(moved).unionByName(split(moved, parted, content)),
            rest(moved_keys).unionByName(split(moved_keys, parted, [F.lit(0)])),
        )

    # the second permutation: stretches of random numbers, each with the rows before it
    n_stretches = max(1, math.ceil(total / shards / STRETCH_ROWS))
    stretch = F.least(F.floor((F.col("_again") / 2.0**64 + 0.5) * n_stretches), F.lit(n_stretches - 1)).cast("int")
    held = moved_keys.withColumn("_stretch", stretch).groupBy("shard", "_stretch").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    held = settle(held.select("shard", "_stretch", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")), "held")
    # every stretch is dealt out on its own, whatever the hash of its number
    inside = Window.partitionBy("shard", "_stretch").orderBy("_again", "_rand", F.col(key))
    moved = moved.withColumn("_stretch", stretch)
    moved = moved.withColumn("_place", F.row_number().over(inside).cast("bigint") - 1)
    out = moved.join(F.broadcast(held) if shards * n_stretches <= 100_000 else held, ["shard", "_stretch"])
    return out.select(*docs.columns, F.col("shard").cast("int").alias("shard"), (F.col("_place") + F.col("_before")).alias("slot"))
