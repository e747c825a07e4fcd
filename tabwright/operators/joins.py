"""A left lookup that no hot key can turn into one slow task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(rows: DataFrame, table: DataFrame, on: Sequence[str], size: str, salt_by: str, salts: int = 256) -> DataFrame:
    """Left join ``rows`` with a table holding one row per key and its row count.

    A key with more than 1/P of all rows (P = shuffle partitions) is looked up by
    broadcast: fewer than P keys can be that large, whatever the data. Their rows,
    and rows with a NULL key, are salted so that the remaining join spreads them.
    ``size`` must count the rows a key stands for.
    """
    p = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    payload = [c for c in table.columns if c not in on]
    total = table.agg(F.sum(size).alias("_total"))
    hot = table.crossJoin(F.broadcast(total)).filter(F.col(size) * p > F.col("_total"))
    hot = hot.select(*on, F.struct(*payload).alias("_hot"))
    r = rows.join(F.broadcast(hot), list(on), "left")
    spread = F.col("_hot").isNotNull()
    for c in on:
        spread = spread | F.col(c).isNull()
    r = r.withColumn("_salt", F.when(spread, F.pmod(F.xxhash64(salt_by), F.lit(salts)) + 1).otherwise(F.lit(0)))
    cold = table.select(*on, F.lit(0).cast("bigint").alias("_salt"), F.struct(*payload).alias("_cold"))
    out = r.join(cold, [*on, "_salt"], "left").withColumn("_got", F.coalesce("_hot", "_cold"))
    return out.select(*rows.columns, *[F.col(f"_got.{c}").alias(c) for c in payload])


