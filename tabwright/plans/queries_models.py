"""Model queries. Probabilities of trained models have no SQL twin; what is certain
about them (coverage, labels, ranges, shapes) is compared, the rest is only run."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabwright.operators import compare as R
from tabwright.operators import transforms as P
from tabwright.plans import cv
from tabwright.plans import models as ML
from tabwright.plans.catalog import query
from tabwright.plans.frame import churn_sql, customer_churn
from tabwright.plans.queries_metrics import fold_sql
from tabwright.plans.queries_transforms import PLAN
from tabwright.session import scratch, settle
from tabwright.sources import sinks


def ready(spark, sf):
    c = settle(P.target_column(customer_churn(spark, sf), "churn"), "customers")
    return c, P.fit_preprocessing(c, PLAN, "churn")


@query(
    "trained_oof_coverage",
    churn_sql(
        """SELECT model, customer_id AS key, fold, churn AS y_true, true AS valid FROM folded, (VALUES ('logistic'), ('forest')) m(model)""",
        fold_sql("churn", "customer_id", 5),
    ),
)
def trained_oof_coverage(spark, sf):
    res = cv.cross_validate(
        customer_churn(spark, sf), "customer_id", "churn", PLAN, [ML.logistic(), ML.random_forest()], k=5
    )
    ok = F.col("prob").between(0, 1) & F.col("prob_cal").between(0, 1)
    return res.oof.select("model", "key", "fold", "y_true", ok.alias("valid"))


@query("logistic_cv_metrics")
def logistic_cv_metrics(spark, sf):
    res = cv.cross_validate(customer_churn(spark, sf), "customer_id", "churn", PLAN, [ML.logistic()], k=5, use_logits=True)
    return res.metrics


@query("trained_comparison")
def trained_comparison(spark, sf):
    res = cv.cross_validate(
        customer_churn(spark, sf), "customer_id", "churn", PLAN,
        [ML.logistic(), ML.random_forest(), ML.mlp()], k=2,
    )
    return R.compare(res.metrics)


@query(
    "logistic_logit_matches_probability",
    churn_sql("SELECT customer_id, 0e0 AS gap FROM churn"),
)
def logistic_logit_matches_probability(spark, sf):
    c, prep = ready(spark, sf)
    x = prep.transform(c).select("customer_id", "label", "features")
    s = ML.score(ML.logistic().fit(x), x)
    gap = F.ln(F.col("prob") / (1.0 - F.col("prob"))) - F.col("logit")
    return s.select("customer_id", (F.round(gap, 6) + 0.0).alias("gap"))


@query("forest_scores")
def forest_scores(spark, sf):
    c, prep = ready(spark, sf)
    x = prep.transform(c).select("customer_id", "label", "features")
    return ML.score(ML.random_forest().fit(x), x).select("customer_id", "prob", "logit")


@query("gbt_early_stopped_scores")
def gbt_early_stopped_scores(spark, sf):
    c, prep = ready(spark, sf)
    x = prep.transform(c).select("customer_id", "label", "features")
    from tabwright.operators.split import stratified_holdout

    parts = settle(stratified_holdout(x, "customer_id", "label"), "gbt")
    train, val = parts.filter("NOT is_test"), parts.filter("is_test")
    model = ML.gbt_depth().fit(train, val)
    return ML.score(model, parts).select("customer_id", "prob", "logit", F.lit(model.getNumTrees).alias("rounds"))


@query("mlp_holdout_metrics")
def mlp_holdout_metrics(spark, sf):
    _, metrics = cv.holdout_evaluate(customer_churn(spark, sf), "customer_id", "churn", PLAN, ML.mlp())
    return metrics


@query(
    "exported_model_scores",
    churn_sql("SELECT customer_id, 0e0 AS gap, 'RandomForestClassifier' AS model_type FROM churn"),
)
def exported_model_scores(spark, sf):
    c, prep = ready(spark, sf)
    forest = ML.random_forest().fit(prep.transform(c).select("label", "features"))
    whole = PipelineModel([*prep.stages.stages, forest])
    meta = {"model_type": "RandomForestClassifier", "n_features": prep.width, "required_features": list(PLAN)}
    loaded, read = sinks.import_model(sinks.export_model(whole, scratch(spark, "champion"), meta))
    a = whole.transform(c).select("customer_id", vector_to_array("probability")[1].alias("a"))
    b = loaded.transform(c).select("customer_id", vector_to_array("probability")[1].alias("b"))
    j = a.join(b, "customer_id")
    return j.select("customer_id", (F.round(F.col("a") - F.col("b"), 9) + 0.0).alias("gap"), F.lit(read["model_type"]).alias("model_type"))


@query(
    "score_responses",
    churn_sql("SELECT customer_id, true AS complete FROM churn"),
)
def score_responses(spark, sf):
    from tabwright.operators.calibrate import select_best_calibrator

    c, prep = ready(spark, sf)
    x = prep.transform(c).select("customer_id", "label", "features")
    s = settle(ML.score(ML.logistic().fit(x), x).drop("features"), "scores")
    out = ML.respond(s, select_best_calibrator(s, "label", "prob", "logit"), key="customer_id")
    label = (F.col("probability_calibrated") >= 0.5).cast("int") == F.col("prediction")
    return out.select("customer_id", (label & F.col("logit").isNotNull() & F.col("probability").between(0, 1)).alias("complete"))


GRID = {f"C={c}": ML.logistic(C=c) for c in (0.01, 0.1, 1.0, 10.0)}


@query("grid_search_front")
def grid_search_front(spark, sf):
    trials = settle(cv.grid_search(customer_churn(spark, sf), "customer_id", "churn", PLAN, GRID, k=5), "trials")
    return R.pareto_front(trials, "roc_auc", "brier")


@query("nested_cv_metrics")
def nested_cv_metrics(spark, sf):
    return cv.nested_cv(customer_churn(spark, sf), "customer_id", "churn", PLAN, GRID, outer=3, inner=3)
