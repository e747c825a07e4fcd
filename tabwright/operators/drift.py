"""Drift between a reference and a current table, and alerts over time."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.operators.rank import long_values, ordered, quantile_row, same_keys
from tabwright.session import bucket_target, settle


def _both(reference: DataFrame, current: DataFrame, cols: Sequence[str], numeric: bool = True) -> DataFrame:
    kind = "double" if numeric else "string"
    pick = [F.col(c).cast(kind).alias(c) for c in cols]
    return reference.select(F.lit(1).alias("_ref"), *pick).unionByName(current.select(F.lit(0).alias("_ref"), *pick))


def _sides() -> list[Column]:
    return [F.sum("_ref").alias("n_ref"), F.sum(1 - F.col("_ref")).alias("n_cur")]


KOLMOGOROV_TERMS = 100


def kolmogorov_tail(lam: Column) -> Column:
    """Asymptotic tail 2 * sum (-1)^(j-1) exp(-2 j^2 lam^2), bounded to [0, 1]."""
    s = F.aggregate(
        F.sequence(F.lit(1), F.lit(KOLMOGOROV_TERMS)),
        F.lit(0.0),
        lambda a, j: a + F.when(j % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * j * j * lam * lam),
    )
    # the series needs many terms near zero, where the tail is 1
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * s)))


def ks_two_sample(reference: DataFrame, current: DataFrame, cols: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """Largest gap between the two distribution functions per column.

    Equal values collapse to one row with a count per side; the running counts
    come from the bucketed global order, so no column is sorted in one task.
    """
    v = long_values(_both(reference, current, cols), cols, ["_ref"])
    counts = v.groupBy("column", "value").agg(*_sides())
    c = ordered(counts, ["column"], "value", ["n_ref", "n_cur"])
    gap = F.abs(F.try_divide(F.col("cum_n_ref"), F.col("tot_n_ref")) - F.try_divide(F.col("cum_n_cur"), F.col("tot_n_cur")))
    g = c.groupBy("column").agg(F.max(gap).alias("statistic"), F.max("tot_n_ref").alias("n_ref"), F.max("tot_n_cur").alias("n_cur"))
    n1, n2 = F.col("n_ref").cast("double"), F.col("n_cur").cast("double")
    p = kolmogorov_tail(F.sqrt(n1 * n2 / (n1 + n2)) * F.col("statistic"))
    return g.select("*", p.alias("p_value")).withColumn("drift", F.col("p_value") < alpha)


TAIL_TERMS = 2_000


def log_gamma_half(dof: Column) -> Column:
    """ln Gamma(dof / 2) for whole dof > 0, as a sum of logarithms."""
    a = dof / 2.0
    steps = F.ceil(a) - 1
    start = F.when(dof % 2 == 1, math.log(math.pi) / 2).otherwise(0.0)
    logs = F.transform(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), lambda k: F.when(k <= steps, F.ln(a - k)).otherwise(0.0))
    return F.aggregate(logs, start, lambda s, x: s + x)


def chi2_tail(x: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution for whole degrees of freedom.

    Q(dof/2, x/2) by the series of the lower part below the mode and by the continued
    fraction above it. NULL without degrees of freedom.
    """
    a, h = dof / 2.0, x / 2.0
    front = F.exp(a * F.ln(h) - h - log_gamma_half(dof))
    steps = F.sequence(F.lit(1), F.lit(TAIL_TERMS))
    zero = F.struct((F.lit(1.0) / a).alias("t"), (F.lit(1.0) / a).alias("s"))
    series = F.aggregate(steps, zero, lambda acc, n: F.struct((acc["t"] * h / (a + n)).alias("t"), (acc["s"] + acc["t"] * h / (a + n)).alias("s")))["s"]
    # the fraction from its far end: b_n = h + 2n + 1 - a, numerators -n (n - a)
    down = F.sequence(F.lit(TAIL_TERMS), F.lit(1), F.lit(-1))
    far = h + 2 * TAIL_TERMS + 1 - a
    fraction = F.aggregate(down, far, lambda acc, n: h + 2 * n - 1 - a - n * (n - a) / acc)
    q = F.when(h < a + 1, F.lit(1.0) - front * series).otherwise(front / fraction)
    return F.when(dof > 0, F.when(h <= 0, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), q))))


def chi_square(reference: DataFrame, current: DataFrame, cols: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """Goodness of fit of the current category shares to the reference ones.

    Both sides are counted in one shuffle. ``unseen`` counts current rows whose
    category the reference never had; they have no expectation to compare with.
    """
    both = _both(reference, current, cols, numeric=False)
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in cols])
    counts = both.select("_ref", F.inline(items)).filter("value IS NOT NULL").groupBy("column", "value").agg(*_sides())
    totals = counts.groupBy("column").agg(
        F.sum("n_ref").alias("_r"), F.sum(F.when(F.col("n_ref") > 0, F.col("n_cur"))).alias("_c")
    )
    j = counts.join(F.broadcast(totals), "column")  # one row per column
    e = F.col("n_ref") * F.col("_c") / F.col("_r")
    part = F.when(F.col("n_ref") > 0, (F.col("n_cur") - e) * (F.col("n_cur") - e) / e)
    g = j.groupBy("column").agg(
        F.sum(part).alias("statistic"),
        (F.count_if(F.col("n_ref") > 0) - 1).alias("dof"),
        F.sum(F.when(F.col("n_ref") == 0, F.col("n_cur")).otherwise(0)).alias("unseen"),
    )
    out = g.withColumn("p_value", chi2_tail(F.col("statistic"), F.col("dof")))
    return out.withColumn("drift", F.col("p_value") < alpha)


# Bands of the population stability index.
PSI_BANDS = ((0.1, "none"), (0.2, "moderate"))
PSI_TOP = "significant"
PSI_FLOOR = 1e-4


def psi(reference: DataFrame, current: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """Population stability index over reference-quantile bins, with its band."""
    probs = [i / bins for i in range(1, bins)]
    q = quantile_row(reference, cols, probs)
    both = _both(reference, current, cols)
    items = []
    for c in cols:
        edges = sorted(set(q[c].values()))
        v, b = F.col(c), F.lit(0)
        for e in edges:
            b = b + (v > F.lit(e)).cast("int")
        items.append(F.struct(F.lit(c).alias("column"), F.when(v.isNotNull(), b).alias("bin"), F.lit(len(edges) + 1).alias("_k")))
    counts = both.select("_ref", F.inline(F.array(*items))).filter("bin IS NOT NULL").groupBy("column", "bin", "_k").agg(*_sides())
    w = Window.partitionBy("column")  # at most `bins` rows per column
    r = F.greatest(F.col("n_ref") / F.sum("n_ref").over(w), F.lit(PSI_FLOOR))
    c = F.greatest(F.col("n_cur") / F.sum("n_cur").over(w), F.lit(PSI_FLOOR))
    parts = counts.select("column", ((c - r) * F.ln(c / r)).alias("_p"))
    out = parts.groupBy("column").agg(F.sum("_p").alias("psi"))
    return out.withColumn("band", psi_band(F.col("psi")))


def psi_band(v: Column) -> Column:
    band = None
    for edge, name in PSI_BANDS:
        band = F.when(v < edge, name) if band is None else band.when(v < edge, name)
    return band.otherwise(PSI_TOP)


def prediction_drift(reference: DataFrame, current: DataFrame, p: str) -> DataFrame:
    """KS and PSI of the score column, one row."""
    k = ks_two_sample(reference, current, [p])
    s = psi(reference, current, [p])
    return k.join(F.broadcast(s), "column")  # one row


def alerts(values: DataFrame, limits: dict[str, tuple[str, float]]) -> DataFrame:
    """Rows of a long ``(..., metric, value)`` table beyond their limit.

    ``limits`` maps a metric to ``("above" | "below", bound)``.
    """
    m, v, hit, bound = F.col("metric"), F.col("value"), F.lit(False), F.lit(None).cast("double")
    for name, (side, x) in limits.items():
        if side not in ("above", "below"):
            raise ValueError("limit side must be 'above' or 'below'")
        hit = hit | ((m == name) & ((v > x) if side == "above" else (v < x)))
        bound = F.when(m == name, F.lit(float(x))).otherwise(bound)
    return values.filter(hit).withColumn("limit", bound)


def cusum(series: DataFrame, by: Sequence[str], order: str, value: str, slack: float = 0.0, limit: float | None = None) -> DataFrame:
    """Two one-sided cumulative sums of deviations from the series mean.

    S_t = max(0, S_{t-1} + x_t - mean - slack) equals C_t - min(0, min C_s) for
    the plain running sum C. Rows are cut into pieces along (series, order). Of a piece its sum and least running sum
    are known; adding sums and taking the least over the pieces before gives what each piece starts from. So
    a series of any length is worked on by many tasks, and only a row per piece goes through a window of the series. A series
    has one row per period, aggregated beforehand. A NULL value leaves the sums as they are and gives NULL.
    """
    v = F.col(value).cast("double")
    cut = series.repartitionByRange(bucket_target(series.sparkSession), *by, order).withColumn("_at", F.spark_partition_id())
    rows = settle(cut, "series")
    keys = [*by, "_at"]
    renamed = [F.col(k).alias("_r_" + k) for k in keys]
    whole = Window.partitionBy(*by)
    pieces = rows.groupBy(*keys).agg(F.sum(v).alias("_s"), F.count(v).alias("_n"))
    # at most (series + pieces) rows from here to the next join
    pieces = pieces.select(*renamed, F.try_divide(F.sum("_s").over(whole), F.sum("_n").over(whole)).alias("_mean"))
    d = rows.join(pieces, same_keys(rows, pieces, keys))
    run = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    up, down = v - F.col("_mean") - slack, F.col("_mean") - v - slack
    d = d.select(*rows.columns, v.isNotNull().alias("_known"), F.coalesce(F.sum(up).over(run), F.lit(0.0)).alias("_up"), F.coalesce(F.sum(down).over(run), F.lit(0.0)).alias("_dn"))
    d = settle(d, "running")
    last = F.max_by(F.struct("_up", "_dn"), order).alias("_end")
    ends = d.groupBy(*keys).agg(last, F.min("_up").alias("_mu"), F.min("_dn").alias("_md"))
    before = whole.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    ends = ends.select(
        *keys, "_mu", "_md",
        *[F.coalesce(F.sum(f"_end.{c}").over(before), zero).alias("_o" + c) for c in ("_up", "_dn")],
    )
    ends = ends.select(
        *renamed, "_o_up", "_o_dn",
        F.coalesce(F.min(F.col("_o_up") + F.col("_mu")).over(before), zero).alias("_l_up"),
        F.coalesce(F.min(F.col("_o_dn") + F.col("_md")).over(before), zero).alias("_l_dn"),
    )
    out = d.join(ends, same_keys(d, ends, keys))

    def side(c: str) -> Column:
        here = F.col("_o" + c) + F.col(c)
        least = F.least(zero, F.col("_l" + c), F.min(here).over(run))
        return F.when(F.col("_known"), here - least)

    out = out.select(*series.columns, side("_up").alias("cusum_high"), side("_dn").alias("cusum_low"))
    if limit is None:
        return out
    return out.withColumn("alarm", (F.col("cusum_high") > limit) | (F.col("cusum_low") > limit))
