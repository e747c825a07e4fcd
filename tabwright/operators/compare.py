"""Run tables and the model comparison built from one long metrics table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.operators.rank import BUCKET, range_splits, with_buckets
from tabwright.session import settle

# What a comparison shows for a metric nobody recorded.
MISSING = {"roc_auc": 0.0, "pr_auc": 0.0, "brier": 1.0, "ece": 1.0, "accuracy": 0.0}
NO_CALIBRATION = "none"


def compare(metrics: DataFrame) -> DataFrame:
    """One row per (run, model): calibrated metrics, else uncalibrated, else the default.

    Reads scopes ``calibrated`` and ``oof`` for the metrics, ``fold`` for the mean
    training time and the text of ``calibration_method``.
    """

    def pick(scope: str, metric: str):
        return F.max(F.when((F.col("scope") == scope) & (F.col("metric") == metric), F.col("value")))

    aggs = [F.coalesce(pick("calibrated", m), pick("oof", m), F.lit(d)).alias(m) for m, d in MISSING.items()]
    timed = (F.col("scope") == "fold") & (F.col("metric") == "training_time")
    aggs.append(F.avg(F.when(timed, F.col("value"))).alias("seconds_per_fold"))
    method = F.max(F.when(F.col("metric") == "calibration_method", F.col("text")))
    aggs.append(F.coalesce(method, F.lit(NO_CALIBRATION)).alias("calibration"))
    return metrics.groupBy("run", "model").agg(*aggs).orderBy("run", F.desc("roc_auc"), "model")


def latest_runs(runs: DataFrame) -> DataFrame:
    """The newest run per kind from ``(run, kind, ts)``."""
    return runs.groupBy("kind").agg(F.max(F.struct("ts", "run")).alias("_m")).select("kind", F.col("_m.run").alias("run"))


def matching_runs(runs: DataFrame, kinds: list[str]) -> DataFrame:
    """Runs that have results of every kind."""
    seen = runs.filter(F.col("kind").isin(kinds)).groupBy("run").agg(F.count_distinct("kind").alias("_k"))
    return seen.filter(F.col("_k") == len(set(kinds))).select("run")


def compare_runs(metrics: DataFrame, runs: DataFrame, which: str = "all", kinds: list[str] | None = None) -> DataFrame:
    """Comparison over the latest run of each kind, or over all runs having every kind."""
    if which == "latest":
        chosen = latest_runs(runs).select("run").distinct()
    elif which == "all":
        chosen = matching_runs(runs, kinds or ["ann", "gbdt"])
    else:
        raise ValueError("which must be 'latest' or 'all'")
    return compare(metrics.join(chosen, "run", "left_semi"))


def winners(comparison: DataFrame) -> DataFrame:
    """The model with the best ROC-AUC of each run; the first name on ties."""
    best = F.min(F.struct((-F.col("roc_auc")).alias("k"), F.col("model"), F.col("roc_auc"))).alias("_b")
    return comparison.groupBy("run").agg(best).select("run", "_b.model", "_b.roc_auc")


def pareto_front(trials: DataFrame, up: str, down: str) -> DataFrame:
    """Trials that no other beats: at least as good in both objectives, better in one.

    Ordered by the first objective, the front is where the running best of the
    second improves. The order is cut into range buckets, each bucket knows the
    best of all better buckets, and no task sees more than one bucket.
    """
    best = settle(trials.groupBy(F.col(up).cast("double").alias("_u")).agg(F.min(down).alias("_d")), "front")
    best = with_buckets(best, range_splits(best, ["_u"]))
    b = "_u" + BUCKET
    inside = Window.partitionBy(b).orderBy(F.desc("_u")).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy().orderBy(F.desc(b)).rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    better = best.groupBy(b).agg(F.min("_d").alias("_m")).select(b, F.min("_m").over(across).alias("_m"))
    rows = best.withColumn("_ahead", F.min("_d").over(inside)).join(better, b)
    ahead = F.least("_ahead", "_m")  # NULL is skipped
    edge = rows.filter(ahead.isNull() | (F.col("_d") < ahead)).select("_u", F.col("_d").alias(down))
    keyed = trials.withColumn("_u", F.col(up).cast("double"))
    return keyed.join(edge, ["_u", down], "left_semi").select(*trials.columns)
