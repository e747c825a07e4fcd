"""Exact binary-classification metrics and curves.

Every metric is computed from one collapsed table with a row per (group, score)
holding the positives ``tp`` and negatives ``fp``. Ties collapse map-side, and
all groups (folds, models, runs) are evaluated in the same job.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.operators.rank import ordered

METRICS = ["roc_auc", "pr_auc", "brier", "ece", "accuracy"]


def bin_edges(n_bins: int) -> list[float]:
    """Equal-width edges of [0, 1] as the exact doubles numpy gives."""
    return [float(e) for e in np.linspace(0.0, 1.0, n_bins + 1)]


def _count_edges(p: Column, edges: Sequence[float], closed: bool) -> Column:
    out = F.lit(0)
    for e in edges:
        out = out + ((p >= F.lit(e)) if closed else (p > F.lit(e))).cast("int")
    return out


def ece_bin(p, n_bins: int = 10) -> Column:
    """Edges at or below p among the upper edges: 0 is the first bin, n is p = 1."""
    return _count_edges(F.col(p) if isinstance(p, str) else p, bin_edges(n_bins)[1:], True)


def curve_bin(p, n_bins: int = 10) -> Column:
    """Inner edges strictly below p, so that bins are (lo, hi]."""
    return _count_edges(F.col(p) if isinstance(p, str) else p, bin_edges(n_bins)[1:-1], False)


def checked_probability(p) -> Column:
    c = F.col(p) if isinstance(p, str) else p
    return F.when(c.between(0.0, 1.0), c).otherwise(
        F.raise_error(F.concat(F.lit("probability outside [0, 1]: "), c.cast("string")))
    )


def score_counts(df: DataFrame, y: str, p: str, by: Sequence[str] = (), check: bool = True) -> DataFrame:
    """Collapse to ``(by..., p, tp, fp)``."""
    score = F.col(p).cast("double")
    src = df.filter(F.col(y).isNotNull() & F.col(p).isNotNull())
    src = src.select(*by, (checked_probability(score) if check else score).alias("p"), F.col(y).alias("_y"))
    return src.groupBy(*by, "p").agg(
        F.count_if(F.col("_y") == 1).alias("tp"), F.count_if(F.col("_y") == 0).alias("fp")
    )


def _ordered(df, y, p, by, check=True, peek=False):
    """Score counts with running sums from the highest score down; ``df`` is read once."""
    return ordered(score_counts(df, y, p, by, check), by, "p", ["tp", "fp"], True, peek)


def _rank_parts(df: DataFrame) -> list[Column]:
    """Per-row shares of ROC-AUC and average precision over a cumulated table."""
    tp, fp, ctp, cfp = (F.col(c).cast("double") for c in ("tp", "fp", "cum_tp", "cum_fp"))
    pos, neg = F.col("tot_tp").cast("double"), F.col("tot_fp").cast("double")
    auc = F.try_divide(fp * (ctp - tp / 2.0), pos * neg)
    ap = F.try_divide(tp, pos) * F.try_divide(ctp, ctp + cfp)
    return [auc.alias("_auc"), ap.alias("_ap")]


def exact_sum(c: str) -> Column:
    """A sum in fixed-point numbers: the same on any layout of the rows."""
    return F.sum(F.col(c).cast("decimal(38,20)")).cast("double")


def _grouped(df: DataFrame, by: Sequence[str]):
    return df.groupBy(*by)


def roc_auc(df: DataFrame, y: str, p: str, by: Sequence[str] = (), single_class: float = 0.0) -> DataFrame:
    """Tie-aware area under the ROC curve; ``single_class`` where undefined.

    ``p`` may be any score here, not only a probability.
    """
    rows = _ordered(df, y, p, by, check=False)
    rows = rows.select(*by, *_rank_parts(rows))
    return _grouped(rows, by).agg(F.coalesce(F.sum("_auc"), F.lit(float(single_class))).alias("roc_auc"))


def average_precision(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    rows = _ordered(df, y, p, by)
    rows = rows.select(*by, *_rank_parts(rows))
    return _grouped(rows, by).agg(F.coalesce(F.sum("_ap"), F.lit(0.0)).alias("pr_auc"))


def brier(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean squared error of the probability; map-side only, no order needed."""
    gap = F.col(p) - F.col(y)
    return df.groupBy(*by).agg(F.avg(gap * gap).alias("brier"))


def accuracy(df: DataFrame, y: str, p: str, by: Sequence[str] = (), t: float = 0.5) -> DataFrame:
    hit = ((F.col(p) > t).cast("int") == F.col(y)).cast("double")
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"))


def ece(df: DataFrame, y: str, p: str, by: Sequence[str] = (), n_bins: int = 10, mode: str = "faithful") -> DataFrame:
    """Expected calibration error.

    ``faithful`` leaves the first bin [0, 1/n) out and gives p = 1 its own bin;
    ``standard`` counts all bins with p = 1 in the last.
    """
    src = df.filter(F.col(y).isNotNull() & F.col(p).isNotNull()).select(
        *by, F.col(y).alias("_y"), checked_probability(F.col(p).cast("double")).alias("_p")
    )
    parts = src.groupBy(*by, _mode_bin("_p", n_bins, mode).alias("_bin")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_y").alias("_sy"), F.sum("_p").alias("_sp")
    )
    return _grouped(parts, by).agg(_ece_of("_bin", "_n", "_sy", "_sp", mode).alias("ece"))


def _mode_bin(p, n_bins: int, mode: str) -> Column:
    if mode == "faithful":
        return ece_bin(p, n_bins)
    if mode == "standard":
        return F.least(ece_bin(p, n_bins), F.lit(n_bins - 1)) + 1
    raise ValueError(f"unknown ece mode: {mode}")


def _ece_of(b, n, sy, sp, mode) -> Column:
    gap = F.abs(F.col(sy) - F.col(sp))
    kept = F.sum(F.when(F.col(b) >= 1, gap).otherwise(0.0))
    return kept / F.sum(n)


def all_metrics_wide(
    df: DataFrame, y: str, p: str, by: Sequence[str] = (), n_bins: int = 10, ece_mode: str = "faithful"
) -> DataFrame:
    """The five metrics of every group, one row per group, in one plan."""
    rows = _ordered(df, y, p, by)
    tp, fp, s = F.col("tp"), F.col("fp"), F.col("p")
    rows = rows.select(
        *by,
        _mode_bin("p", n_bins, ece_mode).alias("_bin"),
        *_rank_parts(rows),
        (tp * (1.0 - s) * (1.0 - s) + fp * s * s).alias("_sq"),
        F.when(s > 0.5, tp).otherwise(fp).alias("_hit"),
        (tp + fp).alias("_n"),
        tp.cast("double").alias("_sy"),
        ((tp + fp) * s).alias("_sp"),
    )
    sums = ["_auc", "_ap", "_sq", "_hit", "_n", "_sy", "_sp"]
    bins = rows.groupBy(*by, "_bin").agg(*[F.sum(c).alias(c) for c in sums])
    return _grouped(bins, by).agg(
        F.coalesce(F.sum("_auc"), F.lit(0.0)).alias("roc_auc"),
        F.coalesce(F.sum("_ap"), F.lit(0.0)).alias("pr_auc"),
        (exact_sum("_sq") / F.sum("_n")).alias("brier"),
        _ece_of("_bin", "_n", "_sy", "_sp", ece_mode).alias("ece"),
        (F.sum("_hit") / F.sum("_n")).alias("accuracy"),
    )


def to_long(wide: DataFrame, by: Sequence[str], metrics: Sequence[str] = METRICS) -> DataFrame:
    return wide.select(
        *by,
        F.inline(
            F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
        ),
    )


def all_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = (), n_bins: int = 10, ece_mode: str = "faithful"):
    """``(by..., metric, value)``."""
    return to_long(all_metrics_wide(df, y, p, by, n_bins, ece_mode), by)


def calibration_curve(df: DataFrame, y: str, p: str, by: Sequence[str] = (), n_bins: int = 10) -> DataFrame:
    """Observed and predicted share per non-empty (lo, hi] bin."""
    src = df.select(*by, F.col(y).alias("_y"), checked_probability(F.col(p).cast("double")).alias("_p"))
    return src.groupBy(*by, curve_bin("_p", n_bins).alias("bin")).agg(
        F.avg("_y").alias("fraction_positive"),
        F.avg("_p").alias("mean_predicted"),
        F.count(F.lit(1)).alias("n"),
    )


def roc_curve(df: DataFrame, y: str, p: str, by: Sequence[str] = (), drop_collinear: bool = False) -> DataFrame:
    """``(by..., threshold, fpr, tpr)`` from (0, 0); a single class gives the diagonal ends.

    ``drop_collinear`` leaves out inner points whose steps before and after are equal.
    """
    rows = _ordered(df, y, p, by, peek=drop_collinear)
    both = (F.col("tot_tp") > 0) & (F.col("tot_fp") > 0)
    body = rows.filter(both)
    if drop_collinear:
        same = (F.col("next_tp") == F.col("tp")) & (F.col("next_fp") == F.col("fp"))
        body = body.filter(~F.coalesce(same, F.lit(False)))
    body = body.select(
        *by,
        F.col("p").alias("threshold"),
        (F.col("cum_fp") / F.col("tot_fp")).alias("fpr"),
        (F.col("cum_tp") / F.col("tot_tp")).alias("tpr"),
    )
    ends = _groups(rows, by).select(
        *by,
        F.explode(F.when(F.col("_both"), F.array(F.lit(0.0))).otherwise(F.array(F.lit(0.0), F.lit(1.0)))).alias("_v"),
    )
    ends = ends.select(*by, F.lit(None).cast("double").alias("threshold"), F.col("_v").alias("fpr"), F.col("_v").alias("tpr"))
    return body.unionByName(ends)


def _groups(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per group of an ordered table: are both classes there, is a positive there."""
    return rows.groupBy(*by).agg(
        ((F.max("tot_tp") > 0) & (F.max("tot_fp") > 0)).alias("_both"), (F.max("tot_tp") > 0).alias("_pos")
    )


def pr_curve(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., threshold, precision, recall)`` closed by (1, 0); without positives (1, 0), (0, 1)."""
    rows = _ordered(df, y, p, by)
    body = rows.filter(F.col("tot_tp") > 0).select(
        *by,
        F.col("p").alias("threshold"),
        (F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))).alias("precision"),
        (F.col("cum_tp") / F.col("tot_tp")).alias("recall"),
    )
    one = F.struct(F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    two = F.struct(F.lit(0.0).alias("precision"), F.lit(1.0).alias("recall"))
    ends = _groups(rows, by).select(
        *by,
        F.lit(None).cast("double").alias("threshold"),
        F.inline(F.when(F.col("_pos"), F.array(one)).otherwise(F.array(one, two))),
    )
    return body.unionByName(ends)


def confusion(df: DataFrame, y: str, p: str, by: Sequence[str] = (), t: float = 0.5) -> DataFrame:
    """Confusion counts with precision, recall and F1 (NULL where undefined)."""
    hit, pos = F.col(p) > t, F.col(y) == 1
    c = df.groupBy(*by).agg(
        F.count_if(hit & pos).alias("tp"),
        F.count_if(hit & ~pos).alias("fp"),
        F.count_if(~hit & pos).alias("fn"),
        F.count_if(~hit & ~pos).alias("tn"),
    )
    return c.select(
        "*",
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
    )


def at_top(df: DataFrame, y: str, p: str, by: Sequence[str] = (), share: float = 0.1) -> DataFrame:
    """Precision and recall among the ``ceil(share * n)`` highest scores.

    Rows tied at the cut share the remaining places equally, so that the answer
    depends on neither row order nor layout.
    """
    rows = _ordered(df, y, p, by)
    n, size = F.col("tot_tp") + F.col("tot_fp"), F.col("tp") + F.col("fp")
    want = F.ceil(F.lit(share) * n)
    before = F.col("cum_tp") + F.col("cum_fp") - size
    taken = F.greatest(F.lit(0), F.least(size, want - before))
    rows = rows.select(*by, (F.col("tp") * taken / size).alias("_hit"), taken.alias("_k"), F.col("tot_tp").alias("_pos"))
    return _grouped(rows, by).agg(
        (F.sum("_hit") / F.sum("_k")).alias("precision_top"),
        F.coalesce(F.try_divide(F.sum("_hit"), F.max("_pos")), F.lit(0.0)).alias("recall_top"),
        F.sum("_k").cast("long").alias("n_top"),
    )


def mean_over_folds(fold_metrics: DataFrame, by: Sequence[str]) -> DataFrame:
    """Unweighted mean and total over folds of a long ``(by..., fold, metric, value)`` table."""
    return fold_metrics.groupBy(*by, "metric").agg(
        F.avg("value").alias("mean"), F.sum("value").alias("total"), F.count("value").alias("folds")
    )


def write_evaluation(df: DataFrame, y: str, p: str, out: str, by: Sequence[str] = (), n_bins: int = 10) -> dict[str, str]:
    """Write the metrics and the three curve tables under ``out``; returns their paths."""
    paths = {n: f"{out}/{n}" for n in ("metrics", "calibration_curve", "roc_curve", "pr_curve")}
    all_metrics(df, y, p, by, n_bins).write.mode("overwrite").json(paths["metrics"])
    calibration_curve(df, y, p, by, n_bins).write.mode("overwrite").parquet(paths["calibration_curve"])
    roc_curve(df, y, p, by).write.mode("overwrite").parquet(paths["roc_curve"])
    pr_curve(df, y, p, by).write.mode("overwrite").parquet(paths["pr_curve"])
    return paths
