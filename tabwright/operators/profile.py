"""Column profiling: a few one-row aggregations, then long tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.scalar import digest, number
from tabwright.operators.moments import pair_correlations
from tabwright.operators.rank import exact_quantiles, long_values, quantile_row
from tabwright.operators.validate import missing_fractions
from tabwright.sources.contract import Contract


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def missing_table(df: DataFrame) -> DataFrame:
    """Columns with missing cells, most missing first."""
    f = missing_fractions(df).filter("missing_count > 0")
    out = f.select("column", "missing_count", (F.col("missing_fraction") * 100.0).alias("missing_pct"))
    return out.orderBy(F.desc("missing_pct"), "column")


def dtype_histogram(df: DataFrame) -> DataFrame:
    """How many columns and non-null cells each type has."""
    return missing_fractions(df).groupBy("dtype").agg(
        F.count(F.lit(1)).alias("columns"), F.sum(F.col("rows") - F.col("missing_count")).alias("cells")
    )


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """``(column, distinct)``, NULL and NaN not counted, 0.0 and -0.0 one value.

    Exact counts collapse (column, value) map-side and shuffle distinct values
    once for all columns; ``approx`` needs no value shuffle.
    """
    columns = list(columns or df.columns)
    if approx:
        floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
        row = df.agg(*[F.approx_count_distinct(number(f"`{c}`") if c in floats else F.col(f"`{c}`"), 0.01).alias(f"_d{i}") for i, c in enumerate(columns)])
        return row.select(
            F.inline(F.array(*[
                F.struct(F.lit(c).alias("column"), F.col(f"_d{i}").alias("distinct")) for i, c in enumerate(columns)
            ]))
        )
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    one = lambda c: number(f"`{c}`") if c in floats else F.col(f"`{c}`")
    values = F.array(*[F.struct(F.lit(c).alias("column"), one(c).cast("string").alias("value")) for c in columns])
    seen = df.select(F.inline(values)).groupBy("column", "value").agg(F.lit(1).alias("_one"))
    return seen.groupBy("column").agg(F.count("value").alias("distinct"))


def numeric_text(df: DataFrame) -> DataFrame:
    """Text columns whose non-null values are all numbers."""
    cols = text_columns(df)
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(f"`{c}`")
        aggs += [F.count(v).alias(f"n{i}"), F.count_if(v.isNotNull() & v.try_cast("double").isNull()).alias(f"b{i}")]
    items = [
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("values"), F.col(f"b{i}").alias("bad"))
        for i, c in enumerate(cols)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*items))).filter("bad = 0").select("column", "values")


def target_stats(df: DataFrame, target: str) -> DataFrame:
    """Mean, median, sample deviation, min, max of the target, one row."""
    t = number(target)
    row = df.agg(F.avg(t).alias("mean"), F.stddev_samp(t).alias("std"), F.min(t).alias("min"), F.max(t).alias("max"))
    med = exact_quantiles(df, [target], [0.5]).select(F.col("value").alias("median"))
    return row.crossJoin(F.broadcast(med))  # one row each


# A target share within these bounds counts as balanced.
BALANCED = (0.3, 0.7)


def class_balance(df: DataFrame, target: str) -> DataFrame:
    t = F.col(target)
    row = df.agg(F.count(t).alias("n"), F.sum(t).cast("bigint").alias("positives"), F.avg(t).alias("rate"))
    label = F.when(F.col("rate").between(*BALANCED), "Balanced").otherwise("Imbalanced")
    return row.select("n", "positives", (F.col("n") - F.col("positives")).alias("negatives"), "rate", label.alias("balance"))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """Equal-width counts per column between its min and max; the last bin is closed."""
    row = df.agg(*[f(number(c)).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max))])
    ranges = row.select(
        F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"lo{i}").alias("lo"), F.col(f"hi{i}").alias("hi"))
            for i, c in enumerate(columns)
        ]))
    )
    # a constant column gets the unit interval around its value
    flat = F.col("lo") == F.col("hi")
    ranges = ranges.select(
        "column",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    v = long_values(df, columns).join(F.broadcast(ranges), "column")  # one row per column
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    b = F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1)).cast("int")
    counts = v.groupBy("column", "lo", "hi", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        "column", "bin", (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins).alias("left_edge"), "n"
    )


def feature_table(df: DataFrame, contract: Contract, approx: bool = False) -> DataFrame:
    """Type, distinct, missing and leakage of every column but the target."""
    cols = [c for c in df.columns if c not in contract.target]
    src = df.select(*[F.col(f"`{c}`") for c in cols])
    base = missing_fractions(src).join(distinct_counts(src, cols, approx), "column", "left")
    out = base.select(
        F.col("column").alias("feature"),
        "dtype",
        F.coalesce("distinct", F.lit(0)).alias("nunique"),
        "missing_count",
        (F.col("missing_fraction") * 100.0).alias("missing_pct"),
        F.col("column").isin(contract.leaky()).alias("is_leaky"),
        F.col("column").isin(contract.training()).alias("is_training"),
    )
    return out.orderBy("is_leaky", F.desc("nunique"), "feature")


# Cardinality bounds of the bands and of the decision rules.
HIGH_CARDINALITY = 50
LOW_CARDINALITY = 10
INTEGER_CATEGORY = 20


def cardinality_band(n: Column) -> Column:
    return F.when(n > HIGH_CARDINALITY, "high").when(n > LOW_CARDINALITY, "medium").otherwise("low")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, min, exact quartiles and max per column."""
    row = df.agg(*[
        f(number(c)).alias(f"{n}{i}")
        for i, c in enumerate(columns)
        for n, f in (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
    ])
    names = ("count", "mean", "std", "min", "max")
    base = row.select(
        F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), *[F.col(f"{n}{i}").alias(n) for n in names]) for i, c in enumerate(columns)
        ]))
    )
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    wide = q.groupBy("column").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))]
    )
    return base.join(wide, "column", "left")


def iqr_outliers(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> DataFrame:
    """Values outside the quartiles by ``factor`` ranges: count and share of all rows."""
    q = quantile_row(df, columns, [0.25, 0.75])
    aggs, items = [F.count(F.lit(1)).alias("_rows")], []
    for i, c in enumerate(columns):
        if not q.get(c):
            continue
        a, b = q[c][0.25], q[c][0.75]
        lo, hi = a - factor * (b - a), b + factor * (b - a)
        v = number(c)
        aggs.append(F.count_if((v < lo) | (v > hi)).alias(f"_o{i}"))
        items.append(
            F.struct(F.lit(c).alias("column"), F.lit(lo).alias("low"), F.lit(hi).alias("high"),
                     F.col(f"_o{i}").alias("outliers"), (F.col(f"_o{i}") / F.col("_rows")).alias("share"))
        )
    return df.agg(*aggs).select(F.inline(F.array(*items)))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), column)
    )


def target_correlations(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Correlation with the target, strongest first; NULL for constants last."""
    out = pair_correlations(df, [(c, target) for c in columns]).select(F.col("a").alias("feature"), "corr")
    return out.orderBy(F.abs("corr").desc_nulls_last(), "feature")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All ordered pairs in long form, the diagonal included."""
    columns = list(columns)
    upper = pair_correlations(df, [(a, b) for i, a in enumerate(columns) for b in columns[i:]])
    same = F.col("a") == F.col("b")
    r = F.when(same & F.col("corr").isNotNull(), F.lit(1.0)).otherwise(F.col("corr"))
    one = F.struct("a", "b", r.alias("corr"))
    flip = F.struct(F.col("b").alias("a"), F.col("a").alias("b"), r.alias("corr"))
    return upper.select(F.inline(F.when(same, F.array(one)).otherwise(F.array(one, flip))))


def rate_by_category(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Rows, positives and rate per value of every categorical, in one shuffle."""
    items = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in columns])
    long = df.select(F.col(target).alias("_y"), F.inline(items)).filter("category IS NOT NULL")
    out = long.groupBy("feature", "category").agg(
        F.count("_y").alias("total_count"),
        F.sum("_y").cast("double").alias("churn_count"),
        F.avg("_y").alias("churn_rate"),
    )
    return out.orderBy("feature", F.desc("churn_rate"), "category")


# Actions of the decision rules and the wording of their reasons.
REASONS = {
    "leaky": "Leaky feature - only available post-label",
    "low": "Low cardinality categorical ({} unique values)",
    "medium": "Medium cardinality categorical ({} unique values)",
    "high": "High cardinality categorical ({} unique values)",
    "integer": "Integer with low cardinality ({} unique values)",
    "scale": "Numeric feature - requires scaling",
    "unknown": "Unknown data type: {}",
}

INTEGRAL = ["tinyint", "smallint", "int", "bigint"]
FRACTIONAL = ["float", "double"]


def decide(features: DataFrame) -> DataFrame:
    """Preprocessing action and reason per row of a feature table."""
    n, dtype = F.col("nunique"), F.col("dtype")
    decimal = dtype.startswith("decimal")
    rules = [
        (F.col("is_leaky"), "drop", "leaky"),
        ((dtype == "string") & (n <= LOW_CARDINALITY), "onehot", "low"),
        ((dtype == "string") & (n <= HIGH_CARDINALITY), "target_encode", "medium"),
        (dtype == "string", "embed", "high"),
        (dtype.isin(INTEGRAL) & (n <= INTEGER_CATEGORY), "onehot", "integer"),
        (dtype.isin(INTEGRAL + FRACTIONAL) | decimal, "scale", "scale"),
        (F.lit(True), "investigate", "unknown"),
    ]

    def words(key: str) -> Column:
        fill = dtype if key == "unknown" else n.cast("string")
        head, *tail = REASONS[key].split("{}")
        return F.concat(F.lit(head), fill, F.lit(tail[0])) if tail else F.lit(head)

    action = reason = None
    for cond, act, key in rules:
        action = F.when(cond, act) if action is None else action.when(cond, act)
        reason = F.when(cond, words(key)) if reason is None else reason.when(cond, words(key))
    out = features.select(
        F.col("feature").alias("name"),
        F.col("dtype").alias("type"),
        F.col("nunique").alias("cardinality"),
        "missing_pct",
        "is_leaky",
        action.alias("action"),
        reason.alias("reason"),
    )
    return out.orderBy("action", "cardinality", "name")


def action_summary(decisions: DataFrame) -> DataFrame:
    """Features per action with the first three names; input has one row per column."""
    names = F.array_sort(F.collect_list(F.struct("cardinality", "name")))
    return decisions.groupBy("action").agg(
        F.count(F.lit(1)).alias("features"),
        F.array_join(F.transform(F.slice(names, 1, 3), lambda x: x["name"]), ", ").alias("examples"),
    )


def dataset_summary(df: DataFrame, contract: Contract) -> DataFrame:
    """One row: size, missing cells, target rate and columns of high cardinality."""
    target = contract.target_name
    f = missing_fractions(df).agg(
        F.max("rows").alias("rows"),
        F.sum("missing_count").alias("missing_cells"),
        F.count_if(F.col("missing_count") > 0).alias("columns_with_missing"),
    )
    rate = df.agg(F.avg(target).alias("rate"))
    wide = distinct_counts(df, [c for c in df.columns if c != target])
    wide = wide.agg(F.count_if(F.col("distinct") > HIGH_CARDINALITY).alias("high_cardinality"))
    out = f.crossJoin(F.broadcast(rate)).crossJoin(F.broadcast(wide))  # one row each
    return out.select(
        "rows",
        F.lit(len(df.columns)).alias("columns"),
        F.lit(len(contract.training())).alias("training_features"),
        F.lit(len(contract.leaky())).alias("leaky_features"),
        "missing_cells",
        "columns_with_missing",
        "rate",
        F.when(F.col("rate").between(*BALANCED), "Balanced").otherwise("Imbalanced").alias("balance"),
        "high_cardinality",
    )


def missing_mask(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """1 where a cell is missing, row by row; no shuffle."""
    return df.select(*keep, *[F.col(c).isNull().cast("int").alias(c) for c in columns])


def missing_by_bucket(df: DataFrame, key: str, columns: Sequence[str], digits: int = 1) -> DataFrame:
    """The mask averaged over key buckets, the form to draw at scale."""
    b = F.substring(digest("mask", key), 1, digits).alias("bucket")
    return df.groupBy(b).agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
