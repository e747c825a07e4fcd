import math
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from tabwright.operators import drift as G


def two(spark, a, b, kind="double"):
    mk = lambda v: spark.createDataFrame([(x,) for x in v], f"x {kind}")
    return mk(a), mk(b)


def ks(a, b):
    pts = sorted(set(a) | set(b))
    return max(abs(sum(x <= t for x in a) / len(a) - sum(x <= t for x in b) / len(b)) for t in pts)


@pytest.mark.parametrize("small", [2, 64])
def test_ks_against_brute_force(spark, small, monkeypatch):
    from tabwright.operators import rank

    monkeypatch.setattr(rank, "bucket_target", lambda spark, rows=0: small)
    rnd = random.Random(2)
    a = [round(rnd.gauss(0, 1), 1) for _ in range(300)]
    b = [round(rnd.gauss(0.6, 1), 1) for _ in range(200)]
    r = G.ks_two_sample(*two(spark, a, b), ["x"]).first()
    assert r["statistic"] == pytest.approx(ks(a, b), abs=1e-12)
    lam = math.sqrt(300 * 200 / 500) * ks(a, b)
    tail = 2 * sum((-1) ** (j - 1) * math.exp(-2 * j * j * lam * lam) for j in range(1, 200))
    assert r["p_value"] == pytest.approx(tail, rel=1e-9)
    assert (r["n_ref"], r["n_cur"]) == (300, 200) and r["drift"]
    same = G.ks_two_sample(*two(spark, a, a), ["x"]).first()
    assert same["statistic"] == 0 and same["p_value"] == 1.0 and not same["drift"]


@pytest.mark.parametrize(
    "x, dof, p",
    [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (7.814727903251179, 3, 0.05), (18.307038053275146, 10, 0.05), (0.0, 4, 1.0)],
)
def test_chi2_tail(spark, x, dof, p):
    got = spark.range(1).select(G.chi2_tail(F.lit(x), F.lit(dof)).alias("p")).first()["p"]
    assert got == pytest.approx(p, abs=1e-9)


def test_chi_square(spark):
    ref, cur = two(spark, ["a"] * 50 + ["b"] * 50, ["a"] * 40 + ["b"] * 10 + ["new"] * 3, "string")
    r = G.chi_square(ref, cur, ["x"]).first()
    assert r["statistic"] == pytest.approx(15 * 15 / 25 * 2) and r["dof"] == 1 and r["unseen"] == 3
    assert r["p_value"] == pytest.approx(math.erfc(math.sqrt(9.0)), abs=1e-12) and r["drift"]


def test_psi_bands(spark):
    rng = np.random.default_rng(0)
    a = [float(v) for v in rng.normal(size=1000)]
    same = G.psi(*two(spark, a, a), ["x"]).first()
    assert same["psi"] == pytest.approx(0, abs=1e-12) and same["band"] == "none"
    far = G.psi(*two(spark, a, [v + 2 for v in a]), ["x"]).first()
    assert far["psi"] > 0.2 and far["band"] == "significant"


def test_cusum_equals_the_recursion(spark):
    rnd = random.Random(9)
    x = [rnd.gauss(0, 1) + (2 if i > 30 else 0) for i in range(60)]
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate(x)], "s string, t int, x double")
    out = G.cusum(df, ["s"], "t", "x", 0.3, 4.0).orderBy("t").collect()
    mu, hi, lo = sum(x) / len(x), 0.0, 0.0
    for v, r in zip(x, out):
        hi, lo = max(0.0, hi + v - mu - 0.3), max(0.0, lo - v + mu - 0.3)
        assert r["cusum_high"] == pytest.approx(hi, abs=1e-9) and r["cusum_low"] == pytest.approx(lo, abs=1e-9)
    assert out[-1]["alarm"]


def test_alerts(spark):
    df = spark.createDataFrame([("auc", 0.4), ("auc", 0.6), ("ece", 0.3), ("other", 9.0)], "metric string, value double")
    out = {(r["metric"], r["value"], r["limit"]) for r in G.alerts(df, {"auc": ("below", 0.5), "ece": ("above", 0.1)}).collect()}
    assert out == {("auc", 0.4, 0.5), ("ece", 0.3, 0.1)}
    with pytest.raises(ValueError):
        G.alerts(df, {"auc": ("beside", 0.5)})


@pytest.mark.parametrize("width", [1, 3, 16])
def test_cusum_of_long_series_in_pieces(spark, monkeypatch, width):
    import random

    monkeypatch.setattr(G, "bucket_target", lambda spark, rows=0: width)
    rng = random.Random(width)
    rows = [(s, t, None if rng.random() < 0.02 else rng.gauss(0, 1) + (t > 300)) for s in ("a", "b", None) for t in range(500 if s == "a" else 60)]
    got = {(r.s, r.t): (r.cusum_high, r.cusum_low, r.alarm) for r in G.cusum(spark.createDataFrame(rows, "s string, t int, v double"), ["s"], "t", "v", 0.25, 5.0).collect()}
    assert len(got) == len(rows)
    for s in ("a", "b", None):
        mine = [(t, v) for k, t, v in rows if k == s]
        known = [v for _, v in mine if v is not None]
        mean, high, low = sum(known) / len(known), 0.0, 0.0
        for t, v in mine:
            if v is None:
                assert got[s, t][:2] == (None, None)
                continue
            high, low = max(0.0, high + v - mean - 0.25), max(0.0, low + mean - v - 0.25)
            assert got[s, t][:2] == pytest.approx((high, low), abs=1e-9) and got[s, t][2] == (high > 5 or low > 5)
