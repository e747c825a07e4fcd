"""Global order: quantiles, running sums, folds."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.functions.scalar import digest
from tabwright.operators import rank as R
from tabwright.operators import split as S


def numbers(spark, values, parts=3):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id bigint, v double").repartition(parts)


@pytest.mark.parametrize("buckets", [2, 40])
def test_exact_quantiles_match_linear_interpolation(spark, buckets, monkeypatch):
    monkeypatch.setattr(R, "bucket_target", lambda spark, rows=0: buckets)
    rng = np.random.default_rng(1)
    x = [float(v) for v in rng.normal(size=2001)]
    y = [float(v) for v in rng.integers(0, 4, size=2001)]  # heavy ties
    df = spark.createDataFrame([(a, b, None if i % 7 == 0 else a) for i, (a, b) in enumerate(zip(x, y))], "x double, y double, z double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r["column"], r["prob"]): r["value"] for r in R.exact_quantiles(df, ["x", "y", "z"], probs).collect()}
    z = [a for i, a in enumerate(x) if i % 7]
    for name, vals in (("x", x), ("y", y), ("z", z)):
        for p in probs:
            assert got[(name, p)] == pytest.approx(float(np.quantile(vals, p)), abs=1e-12), (name, p)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("buckets", [2, 16])
def test_running_sums_agree_with_plain_loop(spark, descending, buckets, monkeypatch):
    monkeypatch.setattr(R, "bucket_target", lambda spark, rows=0: buckets)
    rnd = random.Random(3)
    rows = [(g, float(v), rnd.randint(1, 5)) for g in ("a", None) for v in rnd.sample(range(1000), 200)]
    df = spark.createDataFrame(rows, "g string, v double, n bigint")
    out = R.ordered(df, ["g"], "v", ["n"], descending, peek=True).collect()
    for g in ("a", None):
        mine = sorted([r for r in rows if r[0] == g], key=lambda r: r[1], reverse=descending)
        got = sorted([r for r in out if r["g"] == g], key=lambda r: r["v"], reverse=descending)
        acc = 0
        for i, (a, b) in enumerate(zip(mine, got)):
            acc += a[2]
            assert (b["v"], b["cum_n"]) == (a[1], acc)
            assert b["next_n"] == (mine[i + 1][2] if i + 1 < len(mine) else None)
        assert all(r["tot_n"] == acc for r in got)


def test_fold_sizes_and_layout_invariance(spark):
    df = numbers(spark, [0.0] * 103)
    one = {r["id"]: r["fold"] for r in S.assign_folds(df.coalesce(1), "id", 5).collect()}
    many = {r["id"]: r["fold"] for r in S.assign_folds(df.repartition(8), "id", 5).collect()}
    assert one == many
    sizes = sorted(list(one.values()).count(i) for i in range(5))
    assert sum(sizes) == 103 and sizes[-1] - sizes[0] <= 1
    other = {r["id"]: r["fold"] for r in S.assign_folds(df, "id", 5, seed=7).collect()}
    assert other != one


@pytest.mark.parametrize("step", [1, 2, 4])
def test_digest_cuts_for_any_refinement(spark, step, monkeypatch):
    monkeypatch.setattr(R, "PREFIX_STEP", step)
    df = numbers(spark, [0.0] * 500).withColumn("h", digest(1, "id"))
    order = sorted(r["h"] for r in df.select("h").collect())
    got = R.digest_cuts(df, "h", lambda t: {0: [0, 17, 499, 500]})
    assert got == {0: [order[0], order[17], order[499]]}


def test_hot_key_stays_in_one_fold(spark):
    ids = [1] * 400 + list(range(2, 602))
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    rows = S.assign_folds(df, "id", 3).collect()
    assert len(rows) == len(ids)
    assert len({r["fold"] for r in rows if r["id"] == 1}) == 1


def test_more_folds_than_rows(spark):
    rows = S.assign_folds(numbers(spark, [0.0, 1.0]), "id", 5).collect()
    assert len({r["fold"] for r in rows}) == 2


def test_train_and_val_parts_are_complements(spark):
    f = S.assign_folds(numbers(spark, [0.0] * 30), "id", 3)
    for i in range(3):
        assert S.train_part(f, i).count() + S.val_part(f, i).count() == 30
    oof = S.assemble_oof([S.val_part(f, i) for i in range(3)], "id")
    assert sorted(r["id"] for r in oof.collect()) == list(range(30))


def test_largest_remainder():
    assert S.largest_remainder({0: 83, 1: 17}, 20) == {0: 17, 1: 3}
    assert sum(S.largest_remainder({0: 1, 1: 1, 2: 1}, 2).values()) == 2


def test_stratified_holdout_keeps_class_shares(spark):
    df = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(200)], "id bigint, y int")
    out = S.stratified_holdout(df, "id", "y", 0.2).groupBy("y", "is_test").count().collect()
    got = {(r["y"], r["is_test"]): r["count"] for r in out}
    assert got == {(0, True): 36, (0, False): 144, (1, True): 4, (1, False): 16}


def test_split_needs_two_folds(spark):
    with pytest.raises(ValueError):
        S.assign_folds(numbers(spark, [0.0]), "id", 1)


def test_no_window_over_the_whole_table(spark):
    """Folds are a projection: no shuffle in the plan that assigns them."""
    df = S.assign_folds(spark.range(1000).withColumnRenamed("id", "k"), "k", 5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    assert df.agg(F.count_distinct("fold")).first()[0] == 5


def test_quantiles_take_nan_for_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (float("nan"),), (None,), (-0.0,), (0.0,)], "x double")
    got = {r["prob"]: (r["value"], r["n"]) for r in R.exact_quantiles(df, ["x"], [0.25, 0.5, 1.0]).collect()}
    assert got == {0.25: (0.0, 5), 0.5: (1.0, 5), 1.0: (3.0, 5)}


def test_quantiles_of_any_shape(spark):
    import numpy as np

    from tabwright.operators import rank as R

    rng = np.random.default_rng(3)
    n = 6000
    table = {"normal": rng.standard_normal(n), "ties": rng.integers(0, 4, n).astype(float), "one": np.full(n, 7.0), "tail": np.exp(5 * rng.standard_normal(n)), "gaps": np.where(rng.random(n) < 0.5, np.nan, rng.random(n))}
    rows = [tuple(None if i % 7 == 0 and c == "gaps" else float(v) for c, v in zip(table, r, strict=True)) + (None,) for i, r in enumerate(zip(*table.values(), strict=True))]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in table) + ", empty double")
    probs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.9, 0.9995, 1.0]
    got = {(r["column"], r["prob"]): (r["value"], r["n"]) for r in R.exact_quantiles(df, [*table, "empty"], probs).collect()}
    for c in table:
        known = np.array([r[list(table).index(c)] for r in rows if r[list(table).index(c)] is not None])
        known = known[~np.isnan(known)]
        for p in probs:
            assert got[c, p][0] == pytest.approx(np.quantile(known, p)) and got[c, p][1] == len(known), (c, p)
    assert len(got) == len(table) * len(probs)
    assert R.exact_quantiles(df, ["empty"], probs).count() == 0


def test_quantiles_of_few_rows(spark):
    probs = [i / 10 for i in range(1, 10)] + [0.25, 0.5, 0.75]
    rng = np.random.default_rng(5)
    for n in (2, 34, 302, 1999):
        table = {"a": rng.integers(0, 40, n) / 100, "b": rng.normal(size=n)}
        df = spark.createDataFrame(list(zip(*(v.tolist() for v in table.values()))), "a double, b double")
        got = R.quantile_row(df, ["a", "b"], probs)
        for c, v in table.items():
            assert [got[c].get(p) for p in probs] == pytest.approx(np.quantile(v, probs).tolist()), (n, c)
