import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tabwright.operators import compare as R
from tabwright.operators import transforms as P
from tabwright.plans import cv
from tabwright.plans import models as ML
from tabwright.sources import sinks

PLAN = {"x0": "scale", "x1": "scale", "c": "onehot"}


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(240):
        a, b, c = rnd.gauss(0, 1), rnd.gauss(0, 1), rnd.choice("uvw")
        y = int(rnd.random() < 1 / (1 + math.exp(-(1.5 * a - b + (c == "w")))))
        rows.append((i, a if i % 11 else None, b, c, y))
    return spark.createDataFrame(rows, "id bigint, x0 double, x1 double, c string, y int").cache()


def test_best_round():
    assert ML.best_round([5, 4, 3, 3.5, 3.6, 3.7, 1], patience=3) == 3
    assert ML.best_round([5, 4, 3, 2], patience=3) == 4
    assert ML.best_round([1], patience=3) == 1


def test_logistic_solves_the_penalised_problem(spark, table):
    prep = P.fit_preprocessing(table, PLAN, "y")
    x = P.target_column(prep.transform(table), "y").select("id", "label", "features").cache()
    m = ML.logistic(C=1.0, tol=1e-10).fit(x)
    data = x.collect()
    a = np.array([r["features"].toArray() for r in data])
    a = np.hstack([a, np.ones((len(a), 1))])
    y = np.array([r["label"] for r in data], float)
    w, pen = np.zeros(a.shape[1]), np.diag([1.0] * (a.shape[1] - 1) + [0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ w))
        w -= np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + pen, a.T @ (p - y) + pen @ w)
    assert list(m.coefficients) == pytest.approx(list(w[:-1]), abs=1e-4)
    s = ML.score(m, x).collect()
    assert all(abs(math.log(r["prob"] / (1 - r["prob"])) - r["logit"]) < 1e-6 for r in s)


@pytest.mark.parametrize("family", [ML.random_forest(numTrees=5), ML.gbt_leaf(maxIter=3, maxDepth=2), ML.mlp([4], max_iter=5)])
def test_logits_agree_with_probabilities(spark, table, family):
    prep = P.fit_preprocessing(table, PLAN, "y")
    x = P.target_column(prep.transform(table), "y").select("id", "label", "features").cache()
    for r in ML.score(family.fit(x, None), x).collect():
        p = min(max(r["prob"], ML.LOGIT_CLIP), 1 - ML.LOGIT_CLIP)
        assert math.log(p / (1 - p)) == pytest.approx(r["logit"], abs=1e-5)


def test_patience_refits_the_best_prefix(spark, table):
    prep = P.fit_preprocessing(table, PLAN, "y")
    x = P.target_column(prep.transform(table), "y").select("id", "label", "features").cache()
    train, val = x.filter("id % 4 <> 0"), x.filter("id % 4 = 0")
    model = ML.gbt_depth(patience=2, maxIter=12, maxDepth=4, stepSize=0.5).fit(train, val)
    whole = ML.gbt_depth(maxIter=12, maxDepth=4, stepSize=0.5).fit(train, None)
    losses = whole.evaluateEachIteration(val)
    assert model.getNumTrees == ML.best_round(list(losses), 2)


@pytest.mark.filterwarnings("ignore")
def test_cross_validation(spark, table, tmp_path):
    res = cv.cross_validate(table, "id", "y", PLAN, [ML.logistic(max_iter=30), ML.random_forest(numTrees=5)], k=3, run="r1", use_logits=True)
    oof = res.oof.collect()
    assert len(oof) == 480 and len({(r["model"], r["key"]) for r in oof}) == 480
    assert {r["fold"] for r in oof} == {0, 1, 2}
    by_model = {m: {r["key"]: r["fold"] for r in oof if r["model"] == m} for m in ("logistic", "forest")}
    assert by_model["logistic"] == by_model["forest"]  # the same folds for every family
    m = {(r["model"], r["scope"], r["fold"], r["metric"]): r["value"] for r in res.metrics.collect()}
    assert m[("logistic", "oof", None, "roc_auc")] > 0.7
    folds = [m[("logistic", "fold", i, "brier")] for i in range(3)]
    assert m[("logistic", "mean", None, "brier")] == pytest.approx(sum(folds) / 3)
    assert m[("forest", "total", None, "training_time")] > 0
    c = R.compare(res.metrics).collect()
    assert [r["roc_auc"] for r in c] == sorted([r["roc_auc"] for r in c], reverse=True)
    assert all(r["seconds_per_fold"] > 0 and r["calibration"] in ("platt", "isotonic", "uncalibrated") for r in c)
    sinks.write_oof(res.oof, str(tmp_path / "oof"))
    assert spark.read.parquet(str(tmp_path / "oof")).filter("model = 'forest'").count() == 240


@pytest.mark.filterwarnings("ignore")
def test_cross_validation_is_deterministic(spark, table):
    a, b = (
        {r["key"]: r["prob"] for r in cv.cross_validate(df, "id", "y", PLAN, [ML.logistic(max_iter=20)], k=2).oof.collect()}
        for df in (table.coalesce(1), table.repartition(5))
    )
    assert a.keys() == b.keys() and all(a[i] == pytest.approx(b[i], abs=1e-5) for i in a)


def test_holdout(spark, table):
    rows, metrics = cv.holdout_evaluate(table, "id", "y", PLAN, ML.logistic(max_iter=30))
    assert rows.count() == 48
    assert {r["metric"] for r in metrics.collect()} == {"roc_auc", "pr_auc", "brier", "ece", "accuracy"}


def test_export_import_and_response(spark, table, tmp_path):
    prep = P.fit_preprocessing(table, PLAN, "y")
    x = P.target_column(prep.transform(table), "y").select("label", "features")
    m = ML.logistic(max_iter=20).fit(x)
    root = sinks.export_model(PipelineModel([*prep.stages.stages, m]), str(tmp_path / "m"), {"model_type": "logistic", "n_features": prep.width}, "3")
    back, meta = sinks.import_model(root)
    assert meta == {"model_type": "logistic", "n_features": 5, "version": "3"}
    a = [r["probability"] for r in back.transform(table).orderBy("id").collect()]
    b = [r["probability"] for r in m.transform(prep.transform(table)).orderBy("id").collect()]
    assert a == b
    s = ML.score(m, prep.transform(table)).select("id", "prob", "logit")
    r = ML.respond(s, key="id")
    assert r.columns == ["id", "probability", "probability_calibrated", "logit", "prediction"]
    from tabwright.operators.calibrate import Choice, IsotonicCalibrator, PlattCalibrator

    full = s.join(table.select("id", "y"), "id")
    for method, cal in (("platt", PlattCalibrator().fit(full, "y", "logit")), ("isotonic", IsotonicCalibrator().fit(full, "y", "prob"))):
        rows = ML.respond(full, Choice(method, cal, {}, "prob", "logit"), key="id").orderBy("id").collect()
        want = cal.transform(full, "logit" if method == "platt" else "prob").orderBy("id").collect()
        assert [x["probability_calibrated"] for x in rows] == [x["prob_cal"] for x in want]
    assert r.filter((F.col("probability") >= 0.5) != (F.col("prediction") == 1)).count() == 0


def test_pareto_front(spark):
    rnd = random.Random(1)
    rows = [(i, float(rnd.randint(0, 40)), float(rnd.randint(0, 40))) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, up double, down double")
    got = sorted(r["id"] for r in R.pareto_front(df, "up", "down").collect())
    want = sorted(
        i for i, u, d in rows if not any(u2 >= u and d2 <= d and (u2 > u or d2 < d) for _, u2, d2 in rows)
    )
    assert got == want


def test_run_selection(spark):
    runs = spark.createDataFrame([("a", "ann", 1), ("a", "gbdt", 1), ("b", "gbdt", 2), ("c", "ann", 0)], "run string, kind string, ts int")
    assert {(r["kind"], r["run"]) for r in R.latest_runs(runs).collect()} == {("ann", "a"), ("gbdt", "b")}
    assert [r["run"] for r in R.matching_runs(runs, ["ann", "gbdt"]).collect()] == ["a"]
    with pytest.raises(ValueError):
        R.compare_runs(runs, runs, "some")


def test_training_rows_of_one_file_are_dealt_to_tasks(spark, table, monkeypatch):
    prep = P.fit_preprocessing(table, PLAN, "y")
    x = P.target_column(prep.transform(table.coalesce(1)), "y").select("id", "label", "features")
    families = {"LogisticRegression": ML.logistic(), "RandomForestClassifier": ML.random_forest(), "GBTClassifier": ML.gbt_leaf(), "MultilayerPerceptronClassifier": ML.mlp([4])}
    for share in ("LOGISTIC_SHARE", "TREE_SHARE", "MLP_SHARE"):
        monkeypatch.setattr(ML, share, 60)
    for name, family in families.items():
        seen = []
        monkeypatch.setattr(getattr(ML, name), "fit", lambda self, df, seen=seen: seen.append([len(p) for p in df.rdd.glom().collect()]))
        family.fit(x, None)
        assert len(seen) == 1 and sum(seen[0]) == 240 and len(seen[0]) == 4 and max(seen[0]) <= 70, (name, seen)
