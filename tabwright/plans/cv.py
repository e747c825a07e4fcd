"""Cross-validation of several model families on the same folds."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators import metrics as M
from tabwright.operators import transforms as P
from tabwright.operators.calibrate import Choice, select_best_calibrator
from tabwright.operators.split import assign_folds, stratified_holdout
from tabwright.plans.models import Family, score
from tabwright.session import scratch, settle
from tabwright.sources.sinks import METRIC_COLUMNS, OOF_COLUMNS


@dataclass
class CVResult:
    """``oof``: one row per (model, key). ``metrics``: the long run table."""

    oof: DataFrame
    metrics: DataFrame
    calibration: dict[str, Choice]


def _long(df: DataFrame, run: str, scope: str) -> DataFrame:
    return df.select(
        F.lit(run).alias("run"),
        "model",
        F.lit(scope).alias("scope"),
        F.lit(None).cast("int").alias("fold"),
        "metric",
        "value",
        F.lit(None).cast("string").alias("text"),
    )


def _by_fold(df: DataFrame, fold: str) -> DataFrame:
    """``df`` written with a folder per fold: a filter on the fold reads no other rows."""
    path = scratch(df.sparkSession, "folds")
    df.write.partitionBy(fold).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def cross_validate(
    df: DataFrame,
    key: str,
    target: str,
    plan: dict[str, str],
    families: list[Family],
    k: int = 5,
    seed: int = 42,
    run: str = "run",
    use_logits: bool = False,
    cross_fit: bool = False,
    leaky_prefit: bool = False,
    inner_validation: bool = False,
    unknown: str = "train_mode",
    calibrate: bool = True,
    parallelism: int = 4,
) -> CVResult:
    """K-fold out-of-fold scores, metrics and calibration per family.

    Preprocessing is fitted on the training side of each fold, for all folds in
    one pass; ``leaky_prefit`` fits it once on all rows instead. The table is written once,
    a folder per fold, so that training reads the other folds' folders and scoring its own, each with the plan's columns. Fits run
    from driver threads, scores go to the shared folder as they come.
    ``inner_validation`` stops early on part of the training side, so that a
    validation fold is never used for fitting. Without ``calibrate`` the calibrated
    scores equal the plain ones.
    """
    spark = df.sparkSession
    columns = [c for c, a in plan.items() if a != "drop" and c not in (key, target)]
    src = P.target_column(df, target, "raise", "label").select(
        F.col(key).alias("key"), F.col(target).alias("_target"), "label", *columns, *([key] if key in plan and plan[key] != "drop" else [])
    )
    src = _by_fold(assign_folds(src, "key", k, seed), "fold")
    if leaky_prefit:
        preps = [P.fit_preprocessing(src, plan, "_target", unknown=unknown)] * k
    else:
        preps = P.fit_folds(src, plan, "_target", k, unknown=unknown)
    out = scratch(spark, "oof")

    def one(job: tuple[Family, int]) -> tuple[str, int, float]:
        family, i = job
        start = time.time()
        columns = ["key", "fold", "label", "features"]
        train, val = (preps[i].transform(src.filter(side)).select(*columns) for side in (F.col("fold") != i, F.col("fold") == i))
        stop = val
        if inner_validation:
            parts = stratified_holdout(train, "key", "label", 0.1, seed)
            train, stop = parts.filter(~F.col("is_test")).drop("is_test"), parts.filter("is_test").drop("is_test")
        model = family.fit(train, stop)
        took = time.time() - start
        rows = score(model, val).select("key", F.col("label").alias("y_true"), "prob", "logit")
        rows.write.parquet(f"{out}/model={family.name}/fold={i}")
        return family.name, i, took

    jobs = [(f, i) for f in families for i in range(k)]
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        times = list(pool.map(inheritable_thread_target(spark)(one), jobs))

    raw = spark.read.option("basePath", out).parquet(out)
    calibration, parts = {}, []
    for f in families:
        mine = raw.filter(F.col("model") == f.name)
        if not calibrate:
            parts.append(mine.withColumn("prob_cal", F.col("prob")))
            continue
        choice = select_best_calibrator(
            mine, "y_true", "prob", "logit" if use_logits else None, cross_fit=cross_fit, key="key", seed=seed
        )
        calibration[f.name] = choice
        parts.append(choice.transform(mine, "prob_cal"))
    oof = parts[0]
    for p in parts[1:]:
        oof = oof.unionByName(p)
    oof = settle(oof.select(F.lit(run).alias("run"), "model", "key", F.col("fold").cast("int").alias("fold"), "y_true", "prob", "prob_cal"), "oof-cal")

    # folds, all rows and calibrated rows are scored in one job
    none = F.lit(None).cast("int")
    views = [("fold", F.col("fold"), "prob"), ("oof", none, "prob")] + ([("calibrated", none, "prob_cal")] if calibrate else [])
    views = F.array(*[F.struct(F.lit(s).alias("scope"), f.alias("fold"), F.col(c).alias("q")) for s, f, c in views])
    scored = M.all_metrics(oof.select("model", "y_true", F.inline(views)), "y_true", "q", ["model", "scope", "fold"])
    timed = [(m, "fold", i, "training_time", t) for m, i, t in times]
    timed = spark.createDataFrame(timed, "model string, scope string, fold int, metric string, value double")
    scored = settle(scored.unionByName(timed), "fold-metrics")
    mean = M.mean_over_folds(scored.filter("scope = 'fold'"), ["model"])
    rows = [
        scored.select(F.lit(run).alias("run"), "model", "scope", "fold", "metric", "value", F.lit(None).cast("string").alias("text")),
        _long(mean.select("model", "metric", F.col("mean").alias("value")), run, "mean"),
        _long(mean.filter("metric = 'training_time'").select("model", "metric", F.col("total").alias("value")), run, "total"),
    ]
    chosen = [(run, m, "calibration", None, "calibration_method", None, c.method) for m, c in calibration.items()]
    chosen += [(run, m, "calibration", None, f"brier_{n}", s, None) for m, c in calibration.items() for n, s in c.scores.items()]
    schema = "run string, model string, scope string, fold int, metric string, value double, text string"
    if chosen:
        rows.append(spark.createDataFrame(chosen, schema))
    metrics = rows[0]
    for r in rows[1:]:
        metrics = metrics.unionByName(r)
    return CVResult(oof.select(*OOF_COLUMNS), settle(metrics.select(*METRIC_COLUMNS), "run-metrics"), calibration)


def holdout_evaluate(df: DataFrame, key: str, target: str, plan: dict[str, str], family: Family, test_size: float = 0.2, seed: int = 42):
    """One stratified split: fit on the training part, ``(scored test rows, metrics)``."""
    marked = settle(stratified_holdout(P.target_column(df, target), key, "label", test_size, seed), "holdout")
    train, test = marked.filter(~F.col("is_test")), marked.filter("is_test")
    prep = P.fit_preprocessing(train, plan, target)
    model = family.fit(prep.transform(train).select(key, "label", "features"), None)
    rows = settle(score(model, prep.transform(test).select(key, "label", "features")).select(key, "label", "prob", "logit"), "holdout-scores")
    return rows, M.all_metrics(rows, "label", "prob")


def grid_search(
    df: DataFrame, key: str, target: str, plan: dict[str, str], grid: dict[str, Family], k: int = 3, seed: int = 42, parallelism: int = 4
) -> DataFrame:
    """Mean out-of-fold metrics per trial: ``(trial, roc_auc, pr_auc, brier, ece, accuracy)``.

    The front over (roc_auc up, brier down) is taken with ``pareto_front``.
    """
    named = [Family(name, f.fit) for name, f in grid.items()]
    res = cross_validate(df, key, target, plan, named, k, seed, "grid", calibrate=False, parallelism=parallelism)
    wide = res.metrics.filter("scope = 'mean'").groupBy(F.col("model").alias("trial")).pivot("metric", M.METRICS)
    return wide.agg(F.first("value"))


def nested_cv(
    df: DataFrame, key: str, target: str, plan: dict[str, str], grid: dict[str, Family], outer: int = 3, inner: int = 3, seed: int = 42,
    metric: str = "roc_auc",
) -> DataFrame:
    """Outer folds judge the trial that an inner search chose without seeing them.

    ``(fold, trial, metric, value)``; fits run fold by fold from the driver, each
    one distributed.
    """
    folds = _by_fold(assign_folds(df, key, outer, seed, "_outer"), "_outer")
    out = None
    for i in range(outer):
        train, test = folds.filter(F.col("_outer") != i).drop("_outer"), folds.filter(F.col("_outer") == i).drop("_outer")
        trials = grid_search(train, key, target, plan, grid, inner, seed + 1 + i).collect()  # one row per trial
        worst_first = metric in ("brier", "ece")
        best = sorted(trials, key=lambda r: ((r[metric] if worst_first else -r[metric]), r["trial"]))[0]["trial"]
        prep = P.fit_preprocessing(train, plan, target)
        ready = P.target_column(prep.transform(train), target).select("label", "features")
        model = grid[best].fit(ready, None)
        rows = score(model, P.target_column(prep.transform(test), target).select("label", "features"))
        rows = settle(rows.select("label", "prob"), "outer-scores")
        one = M.all_metrics(rows, "label", "prob").select(F.lit(i).alias("fold"), F.lit(best).alias("trial"), "metric", "value")
        out = one if out is None else out.unionByName(one)
    return out
