import random

import pytest

from tabwright.operators import metrics as M


def table(spark, rows, schema="y int, p double"):
    return spark.createDataFrame(rows, schema)


def brute_auc(y, p):
    pos = [b for a, b in zip(y, p) if a == 1]
    neg = [b for a, b in zip(y, p) if a == 0]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def brute_ap(y, p):
    total, ap, last = sum(y), 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        tp = sum(a for a, b in zip(y, p) if b >= t)
        n = sum(b >= t for b in p)
        ap += (tp / total - last) * tp / n
        last = tp / total
    return ap


@pytest.fixture(scope="module")
def sample():
    rnd = random.Random(5)
    p = [round(rnd.random(), 2) for _ in range(400)]
    y = [int(rnd.random() < 0.2 + 0.5 * v) for v in p]
    return y, p


@pytest.mark.parametrize("small", [2, 64])
def test_auc_and_ap_match_brute_force(spark, sample, small, monkeypatch):
    from tabwright.operators import rank

    monkeypatch.setattr(rank, "bucket_target", lambda spark, rows=0: small)
    y, p = sample
    df = table(spark, list(zip(y, p)))
    m = {r["metric"]: r["value"] for r in M.all_metrics(df, "y", "p").collect()}
    assert m["roc_auc"] == pytest.approx(brute_auc(y, p), abs=1e-12)
    assert m["pr_auc"] == pytest.approx(brute_ap(y, p), abs=1e-12)
    assert m["brier"] == pytest.approx(sum((a - b) ** 2 for a, b in zip(y, p)) / len(y), abs=1e-12)
    assert m["accuracy"] == pytest.approx(sum((b > 0.5) == (a == 1) for a, b in zip(y, p)) / len(y))


def test_singles_agree_with_the_record(spark, sample):
    df = table(spark, list(zip(*sample)))
    m = {r["metric"]: r["value"] for r in M.all_metrics(df, "y", "p").collect()}
    assert M.roc_auc(df, "y", "p").first()[0] == pytest.approx(m["roc_auc"])
    assert M.average_precision(df, "y", "p").first()[0] == pytest.approx(m["pr_auc"])
    assert M.brier(df, "y", "p").first()[0] == pytest.approx(m["brier"])
    assert M.ece(df, "y", "p").first()[0] == pytest.approx(m["ece"])
    assert M.accuracy(df, "y", "p").first()[0] == pytest.approx(m["accuracy"])


def test_ece_fixture_in_both_modes(spark):
    df = table(spark, [(0, 0.25), (0, 0.25), (1, 0.75), (1, 0.75)])
    assert M.ece(df, "y", "p", n_bins=2).first()[0] == pytest.approx(0.125)
    assert M.ece(df, "y", "p", n_bins=2, mode="standard").first()[0] == pytest.approx(0.25)
    assert M.ece(table(spark, [(0, 0.9)] * 3 + [(1, 0.9)]), "y", "p").first()[0] > 0.5


def test_ece_edge_values(spark):
    # 0.3 lies below its edge 0.30000000000000004 and 1.0 has a bin of its own
    df = table(spark, [(1, 0.3), (0, 1.0)])
    rows = {r["p"]: r["b"] for r in df.select("p", M.ece_bin("p").alias("b")).collect()}
    assert rows == {0.3: 2, 1.0: 10}


@pytest.mark.parametrize("rows, expected", [([(0, 0.0), (1, 1.0)], 0.0), ([(0, 0.5), (1, 0.5)], 0.25), ([(0, 1.0), (1, 0.0)], 1.0)])
def test_brier_fixtures(spark, rows, expected):
    assert M.brier(table(spark, rows), "y", "p").first()[0] == pytest.approx(expected)


def test_single_class(spark):
    df = table(spark, [(0, 0.2), (0, 0.4)])
    m = {r["metric"]: r["value"] for r in M.all_metrics(df, "y", "p").collect()}
    assert m["roc_auc"] == 0.0 and m["pr_auc"] == 0.0
    pts = {(r["fpr"], r["tpr"]) for r in M.roc_curve(df, "y", "p").collect()}
    assert pts == {(0.0, 0.0), (1.0, 1.0)}
    pts = {(r["precision"], r["recall"]) for r in M.pr_curve(df, "y", "p").collect()}
    assert pts == {(1.0, 0.0), (0.0, 1.0)}
    assert M.roc_auc(df, "y", "p", single_class=0.5).first()[0] == 0.5


def test_probability_outside_unit_interval_fails(spark):
    with pytest.raises(Exception, match="outside"):
        M.all_metrics(table(spark, [(0, 1.2), (1, 0.3)]), "y", "p").collect()


def test_corner_points_reproduce_the_area(spark, sample):
    y, p = sample
    for drop in (False, True):
        pts = sorted((r["fpr"], r["tpr"]) for r in M.roc_curve(table(spark, list(zip(y, p))), "y", "p", drop_collinear=drop).collect())
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(pts, pts[1:]))
        assert area == pytest.approx(brute_auc(y, p), abs=1e-9)


def test_groups_are_independent(spark, sample):
    y, p = sample
    rows = [("a", *r) for r in zip(y, p)] + [("b", 1 - a, b) for a, b in zip(y, p)]
    out = {r["g"]: r["roc_auc"] for r in M.roc_auc(table(spark, rows, "g string, y int, p double"), "y", "p", ["g"]).collect()}
    assert out["a"] + out["b"] == pytest.approx(1.0)


def test_top_share_splits_ties_evenly(spark):
    df = table(spark, [(1, 0.9)] + [(i % 2, 0.5) for i in range(10)] + [(0, 0.1)] * 9)
    r = M.at_top(df, "y", "p", share=0.2).first()  # 4 places: one at .9, three of ten at .5
    assert r["n_top"] == 4 and r["precision_top"] == pytest.approx((1 + 5 * 3 / 10) / 4)


def test_confusion(spark):
    r = M.confusion(table(spark, [(1, 0.9), (0, 0.8), (1, 0.2), (0, 0.1), (0, 0.5)]), "y", "p").first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (1, 1, 1, 2)
    assert (r["precision"], r["recall"], r["f1"]) == (0.5, 0.5, 0.5)


def test_evaluation_bundle(spark, sample, tmp_path):
    paths = M.write_evaluation(table(spark, list(zip(*sample))), "y", "p", str(tmp_path / "eval"))
    assert spark.read.json(paths["metrics"]).count() == 5
    assert spark.read.parquet(paths["roc_curve"]).columns == ["threshold", "fpr", "tpr"]
