import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.operators import calibrate as C
from tabwright.operators import metrics as M


@pytest.fixture(scope="module")
def scores(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(300):
        y = int(rnd.random() < 0.4)
        z = (2 * y - 1) * 1.0 + rnd.gauss(0, 1.5)
        rows.append((i, y, round(1 / (1 + math.exp(-3 * z)), 3), 3 * z))
    rows = [(i, y, min(max(p, 0.001), 0.999), z) for i, y, p, z in rows]
    return spark.createDataFrame(rows, "id bigint, y int, p double, z double").cache()


def newton_platt(z, y):
    z, y, w = np.array(z), np.array(y, float), np.zeros(2)
    x = np.stack([z, np.ones_like(z)], 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-x @ w))
        g = x.T @ (p - y) + np.array([w[0], 0])
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1.0, 0.0])
        w -= np.linalg.solve(h, g)
    return w


def test_platt_solves_the_penalised_problem(spark, scores):
    c = C.PlattCalibrator().fit(scores, "y", "z")
    rows = scores.collect()
    a, b = newton_platt([r["z"] for r in rows], [r["y"] for r in rows])
    assert c.model.coefficients[0] == pytest.approx(a, abs=1e-5)
    assert c.model.intercept == pytest.approx(b, abs=1e-5)


def pava(points):
    blocks = []
    for _, y, n in points:
        blocks.append([y * n, n])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            s, n2 = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += n2
    return blocks


def test_isotonic_is_increasing_and_keeps_the_mean(spark, scores):
    out = C.IsotonicCalibrator().fit(scores, "y", "p").transform(scores, "p").orderBy("p").collect()
    cal = [r["prob_cal"] for r in out]
    assert all(a <= b + 1e-12 for a, b in zip(cal, cal[1:]))
    assert sum(cal) == pytest.approx(sum(r["y"] for r in out), abs=1e-9)
    g = {}
    for r in out:
        s = g.setdefault(r["p"], [0, 0])
        s[0] += r["y"]
        s[1] += 1
    want = []
    blocks = pava([(p, s / n, n) for p, (s, n) in sorted(g.items())])
    for s, n in blocks:
        want += [s / n] * int(n)
    assert cal == pytest.approx(want, abs=1e-9)


def test_isotonic_out_of_bounds(spark, scores):
    mid = scores.filter("p BETWEEN 0.2 AND 0.8")
    out = {}
    for mode in ("clip", "nan"):
        c = C.IsotonicCalibrator(mode).fit(mid, "y", "p")
        out[mode] = [r["prob_cal"] for r in c.transform(scores, "p").filter("p > 0.9").collect()]
    assert len(set(out["clip"])) == 1 and all(math.isnan(v) for v in out["nan"])
    c = C.IsotonicCalibrator("raise").fit(mid, "y", "p")
    assert c.transform(mid, "p").count() == mid.count()
    with pytest.raises(Exception, match="outside the fitted range"):
        c.transform(scores, "p").collect()
    with pytest.raises(ValueError):
        C.IsotonicCalibrator("wrap")


def test_calibration_does_not_hurt(spark, scores):
    before = M.ece(scores, "y", "p").first()[0]
    platt = C.PlattCalibrator().fit(scores, "y", "z").transform(scores, "z")
    iso = C.IsotonicCalibrator().fit(scores, "y", "p").transform(scores, "p")
    assert M.ece(platt, "y", "prob_cal").first()[0] <= before + 0.05
    assert M.ece(iso, "y", "prob_cal").first()[0] <= before + 0.05


@pytest.mark.parametrize("metric", ["brier", "ece"])
def test_choice_is_never_worse(spark, scores, metric):
    c = C.select_best_calibrator(scores, "y", "p", "z", metric)
    assert set(c.scores) == {"uncalibrated", "platt", "isotonic"}
    assert c.scores[c.method] <= c.scores["uncalibrated"]
    assert c.transform(scores).filter(F.col("prob_cal").between(0, 1)).count() == 300


def test_cross_fit_judges_out_of_sample(spark, scores):
    inside = C.select_best_calibrator(scores, "y", "p").scores["isotonic"]
    outside = C.select_best_calibrator(scores, "y", "p", cross_fit=True, key="id", k=3).scores["isotonic"]
    assert outside > inside


def test_decision_rules():
    assert C.decide({"uncalibrated": 0.2, "isotonic": 0.1, "platt": 0.1}) == "isotonic"
    assert C.decide({"uncalibrated": 0.2, "isotonic": 0.1, "platt": 0.05}) == "platt"
    assert C.decide({"uncalibrated": 0.1, "isotonic": 0.1}) == "uncalibrated"


def test_errors(spark, scores):
    with pytest.raises(ValueError, match="must be fitted"):
        C.PlattCalibrator().transform(scores, "z")
    with pytest.raises(ValueError, match="must be fitted"):
        C.IsotonicCalibrator().transform(scores, "p")
    with pytest.raises(ValueError, match="needs a logit"):
        C.fit_calibrator(scores, "y", p="p", method="platt")
    with pytest.raises(ValueError, match="needs a probability"):
        C.fit_calibrator(scores, "y", logit="z", method="isotonic")
    with pytest.raises(ValueError, match="Unknown calibration method"):
        C.fit_calibrator(scores, "y", p="p", method="beta")


def test_reload_is_equal(spark, scores, tmp_path):
    iso = C.IsotonicCalibrator("nan").fit(scores, "y", "p")
    iso.write(str(tmp_path / "iso"))
    back = C.IsotonicCalibrator.load(str(tmp_path / "iso"))
    assert back.out_of_bounds == "nan"
    a = iso.transform(scores, "p").orderBy("id").collect()
    assert a == back.transform(scores, "p").orderBy("id").collect()
    platt = C.PlattCalibrator().fit(scores, "y", "z")
    platt.write(str(tmp_path / "platt"))
    b = platt.transform(scores, "z").orderBy("id").collect()
    assert b == C.PlattCalibrator.load(str(tmp_path / "platt")).transform(scores, "z").orderBy("id").collect()
