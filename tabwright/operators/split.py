"""Deterministic splits. A row's side depends on (seed, key) and the table, never
on the file layout, so every model sees the same folds."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.scalar import digest
from tabwright.operators.rank import digest_cuts


def assign_folds(
    df: DataFrame, key: str, k: int = 5, seed: int = 42, out: str = "fold", keys: DataFrame | None = None
) -> DataFrame:
    """Shuffled k-fold: contiguous slices of the digest order, sizes within one.

    The k-1 slice borders are found from prefix counts; every row's digest is then
    compared with them, so the table itself is never shuffled. Rows sharing a key
    share a fold. ``keys`` may name a cheaper table with the same keys to count.
    """
    if k < 2:
        raise ValueError("k must be at least 2")
    h = digest(seed, key)

    def borders(totals):
        return {g: [-(-i * n // k) for i in range(1, k)] for g, n in totals.items()}

    counted = (df if keys is None else keys).select(h.alias("_digest"))
    cuts = digest_cuts(counted, "_digest", borders).get(0, [])
    fold = F.lit(0)
    for c in cuts:
        fold = fold + (F.col("_digest") >= c).cast("int")
    return df.withColumn("_digest", h).withColumn(out, fold).drop("_digest")


def train_part(df: DataFrame, i: int, fold: str = "fold") -> DataFrame:
    return df.filter(F.col(fold) != i)


def val_part(df: DataFrame, i: int, fold: str = "fold") -> DataFrame:
    return df.filter(F.col(fold) == i)


def largest_remainder(totals: dict, want: int) -> dict:
    """Share ``want`` places over groups by size; leftovers go to the largest remainders."""
    n = sum(totals.values())
    share = {g: want * c / n for g, c in totals.items()}
    out = {g: int(s) for g, s in share.items()}
    rest = sorted(totals, key=lambda g: (-(share[g] - out[g]), g))
    for g in rest[: want - sum(out.values())]:
        out[g] += 1
    return out


def stratified_holdout(
    df: DataFrame, key: str, target: str, test_size: float = 0.2, seed: int = 42, out: str = "is_test"
) -> DataFrame:
    """Mark ceil(test_size * n) rows as test, shared over classes by largest remainder.

    One border per class; rows are compared with it and never shuffled.
    """
    h = digest(seed, key)
    quota: dict = {}

    def borders(totals):
        quota.update(largest_remainder(totals, math.ceil(test_size * sum(totals.values()))))
        return {g: [q] for g, q in quota.items()}

    counted = df.select(F.col(target).alias("_class"), h.alias("_digest")).filter("_class IS NOT NULL")
    cuts = digest_cuts(counted, "_digest", borders, "_class")
    side = F.lit(False)
    for g, q in quota.items():
        # no border means the class is taken whole
        mine = (F.col("_digest") < cuts[g][0]) if cuts[g] else F.lit(q > 0)
        side = F.when(F.col(target) == g, mine).otherwise(side)
    return df.withColumn("_digest", h).withColumn(out, side).drop("_digest")


def assemble_oof(parts: list[DataFrame], key: str = "key") -> DataFrame:
    """Put the scored validation parts of all folds together; each key once."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
