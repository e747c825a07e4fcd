"""Feature engineering: products, ratios, recency, monthly history, ranks, polynomials."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.operators.joins import lookup
from tabwright.operators.rank import ordered

PRODUCT = re.compile(r"^\s*(\w+)\s*\*\s*(\w+)\s*$")


def interactions(df: DataFrame, products: Sequence[str]) -> DataFrame:
    """Add ``a_x_b`` for every declared ``a * b``; nothing else is accepted."""
    out = {}
    for text in products:
        m = PRODUCT.match(text)
        if not m:
            raise ValueError(f"not a product of two columns: {text!r}")
        a, b = m.groups()
        gone = [c for c in (a, b) if c not in df.columns]
        if gone:
            raise ValueError(f"columns not in the table: {gone}")
        out[f"{a}_x_{b}"] = F.col(a).cast("double") * F.col(b)
    return df.withColumns(out)


def ratio(num, den) -> Column:
    """Quotient, NULL where the denominator is zero or missing."""
    num, den = (F.col(c) if isinstance(c, str) else c for c in (num, den))
    return F.try_divide(num.cast("double"), den.cast("double"))


def days_since(events: DataFrame, key: str, ts: str, asof: str, kinds: dict[str, Column] | None = None) -> DataFrame:
    """Days from the last event up to ``asof``, per key; one column per kind of event.

    ``kinds`` maps output columns to conditions; all are read in one aggregation.
    """
    day = F.lit(asof).cast("timestamp_ntz")
    kinds = kinds or {"days_since_last": F.lit(True)}
    src = events.filter(F.col(ts) <= day)
    last = [F.max(F.when(c, F.col(ts))).alias(n) for n, c in kinds.items()]
    g = src.groupBy(key).agg(*last)
    return g.select(key, *[F.datediff(day.cast("date"), F.col(n).cast("date")).cast("long").alias(n) for n in kinds])


def usage_counts(events: DataFrame, key: str, ts: str, asof: str, counts: dict[str, tuple[int, Column]]) -> DataFrame:
    """Event counts per key in ``(asof - days, asof]`` windows.

    ``counts`` maps output columns to ``(days, condition)``. Only the longest
    window is read; hot keys collapse map-side.
    """
    day = F.lit(asof).cast("timestamp_ntz")
    longest = max(d for d, _ in counts.values())
    start = {d: day - F.expr(f"INTERVAL {int(d)} DAYS") for d in {d for d, _ in counts.values()}}
    src = events.filter((F.col(ts) > start[longest]) & (F.col(ts) <= day))
    return src.groupBy(key).agg(*[F.count_if((F.col(ts) > start[d]) & c).alias(n) for n, (d, c) in counts.items()])


def monthly(events: DataFrame, key: str, ts: str, measures: dict[str, Column]) -> DataFrame:
    """``(key, month, measures...)``; ``month`` counts months from year 0."""
    month = F.year(ts) * 12 + F.month(ts) - 1
    return events.groupBy(key, month.cast("long").alias("month")).agg(*[a.alias(n) for n, a in measures.items()])


def month_history(months: DataFrame, key: str, averages=(), maxima=(), trends=()) -> DataFrame:
    """Trailing aggregates over calendar months, the current one included.

    Each item is ``(column, months)`` and adds ``avg_/max_/trend_<column>_<n>m``;
    a trend is the least-squares slope per month (NULL for a single point). The
    window runs per key over one row per month, however many events a key has.
    """

    def frame(n: int):
        return Window.partitionBy(key).orderBy("month").rangeBetween(-(n - 1), 0)

    out = {f"avg_{c}_{n}m": F.avg(c).over(frame(n)) for c, n in averages}
    out |= {f"max_{c}_{n}m": F.max(c).over(frame(n)) for c, n in maxima}
    for c, n in trends:
        x, y, w = F.col("month").cast("double"), F.col(c).cast("double"), frame(n)
        out[f"trend_{c}_{n}m"] = F.try_divide(F.covar_pop(x, y).over(w), F.var_pop(x).over(w))
    return months.withColumns(out)


def percentile_rank(df: DataFrame, column: str, key: str, out: str = "percentile") -> DataFrame:
    """Average-tie percentile rank in (0, 1]; NULL stays NULL.

    Values are collapsed, ranked through range buckets and looked up again, so a
    value holding a third of the rows is one row while it is ranked.
    """
    src = df.withColumn("_v", F.col(column).cast("double"))
    n = src.filter("_v IS NOT NULL").groupBy("_v").agg(F.count(F.lit(1)).alias("_n"))
    c = ordered(n, [], "_v", ["_n"])
    pct = (F.col("cum__n") - F.col("_n") + (F.col("_n") + 1) / F.lit(2.0)) / F.col("tot__n")
    table = c.select("_v", "_n", pct.alias("_pct"))
    return lookup(src, table, ["_v"], "_n", key).select(*df.columns, F.col("_pct").alias(out))


def z_scores(df: DataFrame, columns: Sequence[str], suffix: str = "_zscore") -> DataFrame:
    """Population z-scores; NULL for a constant column."""
    row = df.agg(*[f(F.col(c).cast("double")).alias(f"_{n}{i}") for i, c in enumerate(columns) for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    z = [F.try_divide(F.col(c) - F.col(f"_m{i}"), F.col(f"_s{i}")).alias(c + suffix) for i, c in enumerate(columns)]
    return df.crossJoin(F.broadcast(row)).select(*df.columns, *z)


def bin_label(c, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the bin [edge, next edge); ``labels`` has one entry more than ``edges``."""
    if len(labels) != len(edges) + 1:
        raise ValueError("give one label more than edges")
    c = F.col(c) if isinstance(c, str) else c
    out = None
    for e, name in zip(edges, labels):
        out = F.when(c < e, name) if out is None else out.when(c < e, name)
    return F.when(c.isNotNull(), out.otherwise(labels[-1]))


def polynomial(df: DataFrame, columns: Sequence[str], degree: int = 2, out: str = "poly") -> DataFrame:
    """All monomials up to ``degree`` as one vector; rows with a missing input fail."""
    stages = VectorAssembler(inputCols=list(columns), outputCol="_raw", handleInvalid="error")
    return PolynomialExpansion(degree=degree, inputCol="_raw", outputCol=out).transform(stages.transform(df)).drop("_raw")


def select_by_importance(importance: DataFrame, least: float = 0.0) -> list[str]:
    """Features whose mean importance is above ``least``; one row per feature."""
    return [r["feature"] for r in importance.filter(F.col("importance_mean") > least).select("feature").collect()]
