"""Permutation importance with one shuffle for all repeats.

Rows are put on a ring in the order of their key's digest; rows of one key follow
each other by a hash of their content. Shifting the ring by s = 1..R places
pairs every row with another one, a permutation without fixed points that
depends on the rows and the seed only, not on the layout. All R shifts are read off the same sorted buckets:
each bucket also gets the first few rows of the next one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.scalar import digest
from tabwright.operators import metrics as M
from tabwright.operators.moments import SUMS_PER_PASS, centred, means
from tabwright.session import bucket_target, settle

#: Hexadecimal digits of a digest that place a row; a key with more than UNIT_ROWS rows and
#: a two-hundredth of the table is divided further by content.
PREFIX = 4
UNIT_ROWS = 50_000
PARTS = 1 << 16


def _ring_buckets(counts: list[tuple[float, int]], need: int, target: int) -> tuple[list[float], list[float]]:
    """Cut sorted (place, rows) into buckets of at least ``need`` rows.

    Returns the first place of each bucket and the last place of each bucket's
    head, the part that the bucket before must also see.
    """
    total = sum(n for _, n in counts)
    want = max(need, -(-total // target))
    starts, heads, sizes = [], [], []
    for prefix, n in counts:
        if not starts or sizes[-1] >= want:
            starts.append(prefix)
            heads.append(prefix)
            sizes.append(0)
        if sizes[-1] < need:
            heads[-1] = prefix
        sizes[-1] += n
    if len(sizes) > 1 and sizes[-1] < need:
        starts.pop(), heads.pop(), sizes.pop()
    return starts, heads


def _placed(df: DataFrame, seed: int, key: str) -> tuple[DataFrame, list[tuple[float, int]]]:
    """Rows with their digest, content hash and place on the ring, and the sorted row count per place.

    A place is the digest's prefix, which holds few rows unless a key has very many. Such
    a key's rows are spread over several places by their content, in ring order.
    """
    src = df.withColumns({"_digest": digest(seed, key), "_content": F.xxhash64(F.lit(seed), *df.columns)})
    prefix = F.conv(F.substring("_digest", 1, PREFIX), 16, 10).cast("double")
    sizes = src.groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()  # at most 16**PREFIX rows
    limit = max(UNIT_ROWS, sum(r["n"] for r in sizes) // 200)
    full = [r["p"] for r in sizes if r["n"] > limit]
    if not full:
        return src.withColumn("_prefix", prefix), sorted((r["p"], r["n"]) for r in sizes)
    # fewer than 200 keys can be that large
    hot = src.filter(prefix.isin(full)).groupBy("_digest").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit).collect()
    share = F.col("_content").cast("double") / 2.0**64 + 0.5
    step, base = F.lit(0), {p: 0 for p in full}
    for r in sorted(hot, key=lambda r: r["_digest"]):
        p, parts = float(int(r["_digest"][:PREFIX], 16)), min(PARTS // 256, -(-r["n"] // limit) * 4)
        inside = F.least(F.floor(share * parts), F.lit(parts - 1)) + 1 + base[p]
        past = base[p] + parts + 1
        here = prefix == p
        step = F.when(here & (F.col("_digest") == r["_digest"]), inside).when(here & (F.col("_digest") > r["_digest"]), F.lit(past)).otherwise(step)
        base[p] = past
    src = src.withColumn("_prefix", prefix + step / F.lit(float(PARTS)))
    again = src.groupBy("_prefix").agg(F.count(F.lit(1)).alias("n")).collect()
    return src, sorted((r["_prefix"], r["n"]) for r in again)


def on_ring(df: DataFrame, key: str, seed: int, carried: Column, repeats: int) -> DataFrame:
    """Add ``_shift1.._shiftR``: ``carried`` of the rows 1..R places ahead on the ring.

    ``df`` is read twice: once for the key, to size the buckets, and once for all.
    """
    src, counts = _placed(df, seed, key)
    total = sum(n for _, n in counts)
    src = src.withColumn("_carried", carried)
    if total < 2:
        raise ValueError("a permutation needs at least two rows")
    # on a ring of n rows shift n is the row itself
    shifts = [(s - 1) % (total - 1) + 1 for s in range(1, repeats + 1)]
    starts, heads = _ring_buckets(counts, max(shifts), bucket_target(df.sparkSession, total))
    n = len(starts)
    if n > 1:
        splits = [float("-inf"), *[float(s) for s in starts[1:]], float("inf")]
        src = Bucketizer(splits=splits, inputCol="_prefix", outputCol="_b").transform(src)
    else:
        src = src.withColumn("_b", F.lit(0.0))
    b = F.col("_b").cast("int")
    head = F.col("_prefix") <= F.element_at(F.array(*[F.lit(float(h)) for h in heads]), b + 1)
    own = F.struct(b.alias("bucket"), F.lit(0).alias("ahead"))
    copy = F.when(head, F.struct(F.pmod(b - 1, F.lit(n)).alias("bucket"), F.lit(1).alias("ahead")))
    placed = src.withColumn("_place", F.explode(F.array(own, copy))).filter("_place IS NOT NULL")
    w = Window.partitionBy("_place.bucket").orderBy("_place.ahead", "_digest", "_content", key)
    out = placed.select(
        *df.columns, F.col("_place.ahead").alias("_ahead"),
        *[F.lead("_carried", s).over(w).alias(f"_shift{i}") for i, s in enumerate(shifts, 1)],
    )
    return out.filter("_ahead = 0").drop("_ahead")


def _summary(long: DataFrame) -> DataFrame:
    """``(feature, values)`` to mean, population deviation and the list, best first."""
    v = F.col("importance_values")
    n = F.size(v)
    mean = F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / n
    out = long.select("feature", mean.alias("importance_mean"), "importance_values")
    var = F.aggregate(v, F.lit(0.0), lambda a, x: a + (x - F.col("importance_mean")) * (x - F.col("importance_mean"))) / n
    out = out.select("feature", "importance_mean", F.sqrt(var).alias("importance_std"), "importance_values")
    return out.orderBy(F.desc_nulls_last("importance_mean"), "feature")


def _check(df: DataFrame, features: Sequence[str]) -> None:
    if not features:
        raise ValueError("give at least one feature")
    gone = [c for c in features if c not in df.columns]
    if gone:
        raise ValueError(f"features not in the table: {gone}")


def residual_importance(
    df: DataFrame,
    features: Sequence[str],
    y: str,
    p: str,
    key: str,
    repeats: int = 10,
    seed: int = 42,
    metric: str | Callable = "roc_auc",
) -> DataFrame:
    """|corr(x, r)| - |corr(x permuted, r)| per feature, with r = y - p.

    Permuting r instead of x gives the same correlations, so one shuffle serves
    every feature and repeat; a permuted r keeps its mean and spread, so a repeat
    costs one sum of products per feature. ``metric`` is only checked: the score
    it names does not enter this measure. Features must be free of missing values.
    """
    _check(df, features)
    _check_metric(metric)
    features = list(features)
    src = df.select(key, *[c for c in features if c != key], (F.col(y).cast("double") - F.col(p)).alias("_r"))
    n, mean, missing = means(src, [*features, "_r"])
    holes = [c for c in (*features, "_r") if missing[c]]
    if holes:
        raise ValueError(f"missing values in: {holes}")
    mr = mean["_r"]
    ring = on_ring(src, key, seed, F.col("_r") - F.lit(mr), repeats)
    step = max(1, SUMS_PER_PASS // (repeats + 2))
    if len(features) > step:
        ring = settle(ring, "ring")  # several passes read it, each its own columns
    out = None
    for i in range(0, len(features), step):
        part = features[i : i + step]
        dr = F.col("_r") - F.lit(mr)
        aggs = [F.sum(dr * dr).alias("_rr")]
        for j, c in enumerate(part):
            d = centred(c, mean[c])
            aggs += [F.sum(d * d).alias(f"_q{j}"), F.sum(d * dr).alias(f"_x{j}_0")]
            aggs += [F.sum(d * F.col(f"_shift{k}")).alias(f"_x{j}_{k}") for k in range(1, repeats + 1)]
        items = []
        for j, c in enumerate(part):
            scale = F.sqrt(f"_q{j}") * F.sqrt("_rr")
            corr = [F.abs(F.try_divide(F.col(f"_x{j}_{k}"), scale)) for k in range(repeats + 1)]
            items.append(F.struct(F.lit(c).alias("feature"), F.array(*[corr[0] - x for x in corr[1:]]).alias("importance_values")))
        one = ring.agg(*aggs).select(F.inline(F.array(*items)))
        out = one if out is None else out.unionByName(one)
    return _summary(out)


def oof_importance(oof: DataFrame, table: DataFrame, features: Sequence[str], key: str = "key", **kw) -> DataFrame:
    """Residual importance of an out-of-fold table joined to its feature table."""
    joined = table.select(key, *[c for c in features if c != key]).join(oof.select(key, "y_true", "prob"), key)
    return residual_importance(joined, features, "y_true", "prob", key, **kw)


METRICS = ("roc_auc", "accuracy")


def _check_metric(metric) -> None:
    if not callable(metric) and metric not in METRICS:
        raise ValueError(f"Unknown metric: {metric}")


def _measure(df: DataFrame, y: str, p: str, by: list[str], metric) -> DataFrame:
    """The metric per group as ``value``; undefined ROC-AUC counts as 0.5."""
    if callable(metric):
        return df.groupBy(*by).agg(metric(F.col(y), F.col(p)).alias("value"))
    if metric == "roc_auc":
        return M.roc_auc(df, y, p, by, single_class=0.5).withColumnRenamed("roc_auc", "value")
    return M.accuracy(df, y, p, by).withColumnRenamed("accuracy", "value")


def model_importance(
    df: DataFrame,
    features: Sequence[str],
    scorer: Callable[[DataFrame], DataFrame],
    y: str,
    key: str,
    metric: str | Callable = "roc_auc",
    repeats: int = 10,
    seed: int = 42,
) -> DataFrame:
    """Drop of the metric when one feature is permuted and the rows are scored again.

    ``scorer`` adds ``prob`` row by row. Variants are exploded next to their row
    and only their collapsed scores are shuffled. ``metric`` may also be a
    function of the label and probability columns that returns an aggregate.
    """
    _check(df, features)
    _check_metric(metric)
    src = df.select(key, y, *[c for c in features if c not in (key, y)])
    base = scorer(src)
    whole = _measure(base.withColumn("_all", F.lit(1)), y, "prob", ["_all"], metric)
    ring = on_ring(src, key, seed, F.struct(*features), repeats)
    variants = []
    for i, f in enumerate(features):
        for k in range(1, repeats + 1):
            mixed = F.struct(*[(F.col(f"_shift{k}")[c] if c == f else F.col(c)).alias(c) for c in features])
            variants.append(F.struct(F.lit(i).alias("_f"), F.lit(k).alias("_k"), mixed.alias("_x")))
    rest = [c for c in (key, y) if c not in features]
    wide = ring.select(*rest, F.inline(F.array(*variants))).select(*rest, "_f", "_k", "_x.*")
    found = _measure(scorer(wide), y, "prob", ["_f", "_k"], metric).withColumnRenamed("value", "_v")
    drop = found.crossJoin(F.broadcast(whole.select("value")))  # one row
    names = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("_f") + 1)
    vals = F.array_sort(F.collect_list(F.struct("_k", (F.col("value") - F.col("_v")).alias("d"))))  # R entries
    long = drop.groupBy(names.alias("feature")).agg(F.transform(vals, lambda x: x["d"]).alias("importance_values"))
    return _summary(long)


def linear_contributions(df: DataFrame, weights: dict[str, float], top_k: int | None = None) -> DataFrame:
    """Mean |weight * (x - mean)| per feature of a linear model, largest first."""
    names = list(weights)
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"_m{i}") for i, c in enumerate(names)])
    src = df.select(*names).crossJoin(F.broadcast(means))  # one row
    row = src.agg(
        *[F.avg(F.abs(F.lit(float(weights[c])) * (F.col(c) - F.col(f"_m{i}")))).alias(f"_c{i}") for i, c in enumerate(names)]
    )
    out = row.select(
        F.inline(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(f"_c{i}").alias("mean_abs_contribution")) for i, c in enumerate(names)
        ]))
    ).orderBy(F.desc("mean_abs_contribution"), "feature")
    return out.limit(top_k) if top_k else out
