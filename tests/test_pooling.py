import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.operators import calibrate as C
from tabwright.operators import pooling as P


def reference(x, w, s):
    """Pooling of the whole list at once."""
    blocks = []
    for a, b, c in sorted(zip(x, w, s, strict=True)):
        blocks.append([a, a, b, c])
        while len(blocks) > 1 and blocks[-2][3] / blocks[-2][2] > blocks[-1][3] / blocks[-1][2]:
            hi = blocks.pop()
            blocks[-1] = [blocks[-1][0], hi[1], blocks[-1][2] + hi[2], blocks[-1][3] + hi[3]]
    return blocks


def curve(blocks, at):
    xs = [v for lo, hi, *_ in blocks for v in ((lo, hi) if lo < hi else (lo,))]
    ys = [s / w for lo, hi, w, s in blocks for _ in range(2 if lo < hi else 1)]
    return np.interp(at, xs, ys)


def cases():
    rng = np.random.default_rng(0)
    n = 3000
    x = rng.permutation(n) / n
    ones = np.ones(n)
    yield "labels", x, ones, (rng.random(n) < x).astype(float)
    yield "rising", x, ones, x
    yield "falling", x, ones, -x
    yield "nearly rising", x, ones, x + 0.002 * rng.standard_normal(n)
    yield "weights", x, 1.0 + rng.integers(0, 5, n), rng.standard_normal(n)
    yield "last one undoes all", x, ones, np.where(x == x.max(), -1e6, x)


@pytest.mark.parametrize("chunk,fan", [(8, 2), (64, 3), (4096, 16)])
def test_equal_to_pooling_at_once(spark, monkeypatch, chunk, fan):
    monkeypatch.setattr(P, "CHUNK", chunk)
    monkeypatch.setattr(P, "FAN", fan)
    for name, x, w, s in [c for i, c in enumerate(cases()) if chunk == 64 or i % 3 == (chunk == 8)]:
        df = spark.createDataFrame(list(zip(x.tolist(), w.tolist(), s.tolist(), strict=True)), "x double, w double, s double")
        got = P.isotonic_blocks(df).collect()
        want = reference(x.tolist(), w.tolist(), s.tolist())
        at = np.linspace(-0.1, 1.1, 500)
        assert curve([(r.lo, r.hi, r.w, r.w * r.value) for r in sorted(got, key=lambda r: r.lo)], at) == pytest.approx(curve(want, at)), name
        assert sorted(got, key=lambda r: (r.chunk, r["at"])) == sorted(got, key=lambda r: r.lo), name


def test_many_blocks(spark):
    """10^5 blocks that no pooling joins stay where they are."""
    df = spark.range(100_000).select((F.col("id") / 100_000).alias("x"), F.lit(1.0).alias("w"), (F.col("id") / 100_000).alias("s"))
    blocks = P.isotonic_blocks(df)
    assert blocks.count() == 100_000
    assert blocks.filter("lo <> hi OR abs(value - lo) > 1e-12").count() == 0


@pytest.mark.parametrize("most", [0, 1 << 18])
def test_calibrator_by_model_and_by_join(spark, monkeypatch, tmp_path, most):
    monkeypatch.setattr(C, "MODEL_LINES", most)
    rng = np.random.default_rng(1)
    p = np.round(rng.random(2000), 3)
    y = (rng.random(2000) < p).astype(int)
    df = spark.createDataFrame(list(zip(p.tolist(), y.tolist(), strict=True)), "p double, y int")
    cal = C.IsotonicCalibrator().fit(df, "y", "p")
    assert (cal.model is None) == (most == 0)
    keys = sorted(set(p.tolist()))
    want = reference(keys, [float((p == k).sum()) for k in keys], [float(y[p == k].sum()) for k in keys])
    new = [*keys, *np.linspace(-1, 2, 301).tolist(), None, float("nan")]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(new)], "id int, p double")
    cal.write(str(tmp_path / "cal"))
    for c in (cal, C.IsotonicCalibrator.load(str(tmp_path / "cal"))):
        got = {r.id: r.prob_cal for r in c.transform(rows, "p").collect()}
        assert [got[i] for i in range(len(new) - 2)] == pytest.approx(curve(want, new[:-2]))
        assert got[len(new) - 2] is None and got[len(new) - 1] is None


def test_one_score(spark):
    cal = C.IsotonicCalibrator().fit(spark.createDataFrame([(0.5, 1), (0.5, 0)], "p double, y int"), "y", "p")
    assert [r.prob_cal for r in cal.transform(spark.createDataFrame([(0.1,), (0.9,)], "p double"), "p").collect()] == [0.5, 0.5]
