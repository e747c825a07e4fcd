import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.operators import moments as M


def table(spark, width, n=400):
    rng = np.random.default_rng(width)
    x = rng.standard_normal((n, width)) + 1000.0
    x[:, 1] = 3.0
    x[rng.random((n, width)) < 0.1] = np.nan
    x[:, 0] = 5 * x[:, 2]
    names = [f"v{i}" for i in range(width)]
    rows = [[None if np.isnan(v) else float(v) for v in r] for r in x]
    return x, names, spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(5)


def test_wide_and_narrow_ways_agree(spark, monkeypatch):
    x, names, df = table(spark, 12)
    pairs = list(itertools.combinations(names, 2))
    narrow = {(r.a, r.b): r.corr for r in M.pair_correlations(df, pairs).collect()}
    monkeypatch.setattr(M, "SUMS_PER_PASS", 0)
    wide = {(r.a, r.b): r.corr for r in M.pair_correlations(df, pairs).collect()}
    assert wide.keys() == narrow.keys() == set(pairs)
    for (a, b), r in wide.items():
        i, j = names.index(a), names.index(b)
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        if "v1" in (a, b):
            assert r is None and narrow[a, b] is None
        else:
            assert r == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)
            assert r == pytest.approx(narrow[a, b], abs=1e-9)


def test_five_hundred_columns_in_two_passes(spark):
    x, names, df = table(spark, 500, 60)
    pairs = list(itertools.combinations(names, 2))
    out = M.pair_correlations(df.fillna(0.0), pairs)
    assert out.count() == len(pairs) == 124_750
    top = out.filter("a = 'v0' AND b = 'v2'").first()["corr"]
    known = np.nan_to_num(x)
    assert top == pytest.approx(np.corrcoef(known[:, 0], known[:, 2])[0, 1], abs=1e-9)


def test_empty_table(spark, monkeypatch):
    monkeypatch.setattr(M, "SUMS_PER_PASS", 0)
    _, names, df = table(spark, 3)
    assert [tuple(r) for r in M.pair_correlations(df.filter(F.lit(False)), [("v0", "v2")]).collect()] == [("v0", "v2", None)]
