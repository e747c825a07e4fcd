import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.functions.scalar import digest
from tabwright.operators import importance as I


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(42)
    n = 300
    signal = rng.normal(size=(n, 2))
    junk = rng.uniform(-10, 10, size=(n, 3))
    logits = 2 * signal[:, 0] + signal[:, 1]
    y = (rng.uniform(size=n) < 1 / (1 + np.exp(-logits))).astype(int)
    rows = [(i, *map(float, signal[i]), *map(float, junk[i]), int(y[i]), 0.5) for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, s0 double, s1 double, j0 double, j1 double, j2 double, y int, p double").cache()


FEATS = ["s0", "s1", "j0", "j1", "j2"]


def ring_of(df, shifts):
    order = [r["id"] for r in df.withColumn("h", digest(42, "id")).orderBy("h").collect()]
    n = len(order)
    return {order[i]: [order[(i + s) % n] for s in shifts] for i in range(n)}


@pytest.mark.parametrize("target", [1, 8, 200])
def test_ring_is_the_same_for_any_bucketing(spark, table, target, monkeypatch):
    monkeypatch.setattr(I, "bucket_target", lambda s, rows=0: target)
    out = I.on_ring(table.select("id"), "id", 42, F.col("id"), 7).collect()
    want = ring_of(table.select("id"), range(1, 8))
    assert len(out) == 300
    assert {r["id"]: [r[f"_shift{k}"] for k in range(1, 8)] for r in out} == want


@pytest.mark.parametrize("n", [2, 3, 8])
def test_ring_with_more_repeats_than_rows(spark, n):
    df = spark.range(n)
    out = I.on_ring(df, "id", 42, F.col("id"), 10).collect()
    assert len(out) == n
    for k in range(1, 11):
        col = [r[f"_shift{k}"] for r in out]
        assert sorted(col) == list(range(n))  # a permutation
        assert all(r["id"] != r[f"_shift{k}"] for r in out)  # without fixed points
    with pytest.raises(ValueError):
        I.on_ring(spark.range(1), "id", 42, F.col("id"), 1)


def test_bucket_cuts():
    # eight rows in three buckets: at least three rows each, the short rest joins the last
    starts, heads = I._ring_buckets([(0, 1), (1, 1), (5, 1), (9, 4), (12, 1)], 2, 3)
    assert starts == [0, 9] and heads == [1, 9]
    rnd = random.Random(0)
    counts = [(p, rnd.randint(1, 4)) for p in range(500)]
    for need, target in ((1, 64), (5, 16), (50, 300)):
        starts, heads = I._ring_buckets(counts, need, target)
        cut = [*starts, 10**9]
        for a, b, h in zip(cut, cut[1:], heads):
            assert sum(n for p, n in counts if a <= p < b) >= need
            assert sum(n for p, n in counts if a <= p <= h) >= need


def test_signal_outranks_junk(spark, table):
    out = I.residual_importance(table, FEATS, "y", "p", "id", 5).collect()
    names = [r["feature"] for r in out]
    assert set(names[:2]) == {"s0", "s1"}
    assert all(len(r["importance_values"]) == 5 and r["importance_std"] >= 0 for r in out)


def test_residual_importance_matches_numpy(spark, table):
    rows = {r["id"]: r for r in table.collect()}
    ring = ring_of(table.select("id"), range(1, 4))
    r = {i: v["y"] - v["p"] for i, v in rows.items()}
    ids = sorted(rows)
    out = {x["feature"]: x for x in I.residual_importance(table, FEATS, "y", "p", "id", 3).collect()}
    for f in FEATS:
        x = [rows[i][f] for i in ids]
        base = abs(np.corrcoef(x, [r[i] for i in ids])[0, 1])
        vals = [base - abs(np.corrcoef(x, [r[ring[i][k]] for i in ids])[0, 1]) for k in range(3)]
        assert out[f]["importance_values"] == pytest.approx(vals, abs=1e-10)
        assert out[f]["importance_std"] == pytest.approx(np.std(vals), abs=1e-10)


def test_many_features_take_several_passes(spark, table, monkeypatch):
    whole = I.residual_importance(table, FEATS, "y", "p", "id", 3).collect()
    monkeypatch.setattr(I, "SUMS_PER_PASS", 10)
    parts = I.residual_importance(table, FEATS, "y", "p", "id", 3).collect()
    assert [r["feature"] for r in whole] == [r["feature"] for r in parts]
    assert [r["importance_mean"] for r in whole] == pytest.approx([r["importance_mean"] for r in parts])


def test_constant_feature_is_last_and_missing_is_refused(spark, table):
    out = I.residual_importance(table.withColumn("c", F.lit(1.0)), ["c", "s0"], "y", "p", "id", 2).collect()
    assert out[-1]["feature"] == "c" and out[-1]["importance_mean"] is None
    holed = table.withColumn("s0", F.when(F.col("id") > 5, F.col("s0")))
    with pytest.raises(ValueError, match="missing values"):
        I.residual_importance(holed, ["s0"], "y", "p", "id", 2)


def closed(df):
    z = 2.0 * F.col("s0") + F.col("s1")
    return df.withColumn("prob", 1.0 / (1.0 + F.exp(-z)))


@pytest.mark.parametrize("metric", ["roc_auc", "accuracy"])
def test_model_importance(spark, table, metric):
    out = {r["feature"]: r["importance_mean"] for r in I.model_importance(table, ["s0", "s1", "j0"], closed, "y", "id", metric, 3).collect()}
    assert out["s0"] > out["s1"] > out["j0"] == pytest.approx(0.0)


def test_argument_checks(spark, table):
    with pytest.raises(ValueError, match="Unknown metric"):
        I.residual_importance(table, FEATS, "y", "p", "id", metric="gini")
    with pytest.raises(ValueError, match="not in the table"):
        I.residual_importance(table, ["nope"], "y", "p", "id")
    with pytest.raises(ValueError, match="at least one"):
        I.model_importance(table, [], closed, "y", "id")


def test_linear_contributions(spark, table):
    out = I.linear_contributions(table, {"s0": 2.0, "s1": 1.0, "j0": 0.0}, 2).collect()
    assert [r["feature"] for r in out] == ["s0", "s1"]


@pytest.mark.parametrize("unit, target", [(20, 64), (5, 8), (10**6, 8)])
def test_ring_with_a_hot_key_is_the_same_on_any_layout(spark, monkeypatch, unit, target):
    """One order, whatever the bounds, the buckets and the files."""
    df = spark.range(300).select(F.when(F.col("id") < 100, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    plain = {r["v"]: (r["_shift1"], r["_shift3"]) for r in I.on_ring(df.coalesce(1), "k", 1, F.col("v"), 3).collect()}
    monkeypatch.setattr(I, "UNIT_ROWS", unit)
    monkeypatch.setattr(I, "bucket_target", lambda s, rows=0: target)
    other = {r["v"]: (r["_shift1"], r["_shift3"]) for r in I.on_ring(df.repartition(5), "k", 1, F.col("v"), 3).collect()}
    assert other == plain


def test_hot_key_rows_are_told_apart(spark):
    df = spark.range(300).select(F.when(F.col("id") < 100, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    out = I.on_ring(df, "k", 1, F.col("v"), 2).collect()
    assert sorted(r["_shift1"] for r in out) == list(range(300)) == sorted(r["_shift2"] for r in out)
