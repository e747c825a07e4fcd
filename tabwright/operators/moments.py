"""Correlations from centred sums: as one generated aggregation while the pairs fit one, as
products of blocks of rows with all columns beyond that."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pairs that one generated aggregation holds.
SUMS_PER_PASS = 240
#: Rows whose products are taken at a time, and partial sums that one task adds up.
BLOCK_ROWS, FAN = 8192, 64


def means(df: DataFrame, columns: Sequence[str]) -> tuple[int, dict[str, float | None], dict[str, int]]:
    """Row count, mean and missing count per column, one pass and one row."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(columns):
        aggs += [F.avg(F.col(c).cast("double")).alias(f"m{i}"), F.count(c).alias(f"c{i}")]
    r = df.agg(*aggs).first()
    return r["_n"], {c: r[f"m{i}"] for i, c in enumerate(columns)}, {c: r["_n"] - r[f"c{i}"] for i, c in enumerate(columns)}


def centred(c: str, mean: float | None):
    return F.col(c).cast("double") - F.lit(mean if mean is not None else 0.0)


def gram(df: DataFrame, columns: Sequence[str], mean: dict[str, float | None]) -> DataFrame:
    """``(i, line)``: of column i with every column, over the rows where both are known, the products, the sums and sums of
    squares of i, and the number of rows, as 4 x columns doubles.

    Each task multiplies blocks of rows with all columns and sends one row per column; these are added up in two
    steps. So a table of any width is read once, and what is shuffled does not grow with its rows.
    """
    width = len(columns)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sums = np.zeros((4, width, width))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                b = batch.slice(at, BLOCK_ROWS)
                x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns]).astype(np.float64)
                known = ~np.isnan(x)
                x, m = np.where(known, x, 0.0), known.astype(np.float64)
                sums += np.stack([x.T @ x, x.T @ m, (x * x).T @ m, m.T @ m])
        if sums[3].any():
            number = TaskContext.get().partitionId()
            lines = [sums[:, i].tobytes() for i in range(width)]
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([number] * width, pa.int32()), pa.array(lines, pa.binary())], names=["i", "part", "line"])

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")  # sums of floating numbers depend on their order
        total = np.zeros(4 * width)
        for line in table.column("line"):
            total += np.frombuffer(line.as_py())
        return pa.table({"i": table.column("i").slice(0, 1), "part": table.column("part").slice(0, 1), "line": pa.array([total.tobytes()], pa.binary())})

    schema = "i int, part int, line binary"
    # NaN stands for a missing value from here on, as it does everywhere in a number column
    rows = df.select(*[F.coalesce(centred(c, mean[c]), F.lit(float("nan"))).alias(f"c{i}") for i, c in enumerate(columns)])
    some = rows.mapInArrow(part, schema).withColumn("_group", F.pmod("part", F.lit(FAN)))
    some = some.groupBy("i", "_group").applyInArrow(add, schema)
    return some.groupBy("i").applyInArrow(add, schema).select("i", "line")


def _wide_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]], columns: Sequence[str], mean: dict[str, float | None]) -> DataFrame:
    spark = df.sparkSession
    place = {c: i for i, c in enumerate(columns)}
    wanted: dict[int, list[int]] = {}
    for a, b in pairs:
        wanted.setdefault(place[a], []).append(place[b])
    sums = gram(df, columns, mean)
    width, names = len(columns), list(columns)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, line in zip(batch.column("i").to_pylist(), batch.column("line"), strict=True):
                v = np.frombuffer(line.as_py()).reshape(4, width)
                cols = [pa.array([i] * width, pa.int32()), pa.array(range(width), pa.int32()), *[pa.array(x) for x in v]]
                yield pa.RecordBatch.from_arrays(cols, names=["i", "j", "x", "s", "q", "n"])

    # a row per pair of columns from here on
    each = sums.mapInArrow(read, "i int, j int, x double, s double, q double, n double")
    asked = spark.createDataFrame([(a, b, names[a], names[b]) for a, bs in wanted.items() for b in bs], "i int, j int, a string, b string")
    here = asked.join(each, ["i", "j"], "left")
    there = each.select(F.col("j").alias("i"), F.col("i").alias("j"), F.col("s").alias("s2"), F.col("q").alias("q2"))
    both = here.join(there, ["i", "j"], "left")
    cov = F.col("x") - F.try_divide(F.col("s") * F.col("s2"), F.col("n"))
    va, vb = (F.col(q) - F.try_divide(F.col(s) * F.col(s), F.col("n")) for q, s in (("q", "s"), ("q2", "s2")))
    r = F.when((va > 0) & (vb > 0), F.try_divide(cov, F.sqrt(va) * F.sqrt(vb)))
    return both.select("a", "b", r.alias("corr"))


def pair_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``(a, b, corr)`` over pairwise-complete rows; NULL for a constant side.

    A first pass gives the means, a second all sums. Up to ``SUMS_PER_PASS`` pairs are sums of one aggregation: a pair
    of complete columns needs one of centred products, a pair with missing values six. More pairs are read off ``gram``.
    """
    columns = list(dict.fromkeys(c for p in pairs for c in p))
    _, mean, missing = means(df, columns)
    if len(pairs) > SUMS_PER_PASS:
        return _wide_correlations(df, pairs, columns, mean)
    aggs, used = [], {}
    for c in columns:
        d = centred(c, mean[c])
        used[c] = len(used)
        aggs += [F.sum(d * d).alias(f"q{used[c]}"), F.sum(d).alias(f"s{used[c]}"), F.count(c).alias(f"n{used[c]}")]
    items = []
    for i, (a, b) in enumerate(pairs):
        da, db = centred(a, mean[a]), centred(b, mean[b])
        aggs.append(F.sum(da * db).alias(f"x{i}"))
        if missing[a] or missing[b]:
            both = F.col(a).isNotNull() & F.col(b).isNotNull()
            known_a, known_b = F.when(both, da), F.when(both, db)
            aggs += [
                F.sum(known_a).alias(f"a{i}"), F.sum(known_b).alias(f"b{i}"), F.sum(known_a * known_a).alias(f"aa{i}"),
                F.sum(known_b * known_b).alias(f"bb{i}"), F.count_if(both).alias(f"k{i}"),
            ]
            n, sa, sb, qa, qb = (F.col(f"{x}{i}") for x in ("k", "a", "b", "aa", "bb"))
        else:
            ua, ub = used[a], used[b]
            n, sa, sb, qa, qb = (F.col(x) for x in (f"n{ua}", f"s{ua}", f"s{ub}", f"q{ua}", f"q{ub}"))
        cov = F.col(f"x{i}") - F.try_divide(sa * sb, n)
        va, vb = qa - F.try_divide(sa * sa, n), qb - F.try_divide(sb * sb, n)
        r = F.when((va > 0) & (vb > 0), F.try_divide(cov, F.sqrt(va) * F.sqrt(vb)))
        items.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), r.alias("corr")))
    return df.agg(*aggs).select(F.inline(F.array(*items)))
