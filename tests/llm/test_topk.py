import math
import random

import pytest

from tabwright.llm import topk


def brute(rows, query_ids, k):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.setdefault(i, []).append([math.floor(1024 * x) for x in v])
    out = []
    for q in sorted(query_ids):
        for v in good.get(q, [])[:1]:
            scored = sorted((-sum(a * b for a, b in zip(v, c, strict=True)), i) for i, cs in good.items() if i != q for c in cs if len(c) == len(v))
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return out


@pytest.mark.parametrize("query_bytes, tile, fan", [(16 << 20, 4096, 8), (400, 7, 2)])
def test_equals_brute_force(spark, monkeypatch, query_bytes, tile, fan):
    monkeypatch.setattr(topk, "TILE_ROWS", tile)
    monkeypatch.setattr(topk, "TILE_QUERIES", 3)
    monkeypatch.setattr(topk, "FAN_IN", fan)
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1.0, -0.25, 0.1, 0.5]) for _ in range(4)]) for i in range(150)]
    rows += [(200, None), (201, [1.0, None, 0.0, 0.0]), (202, [float("nan")] * 4), (203, [float("inf"), 0.0, 0.0, 0.0]), (204, []), (205, []), (206, [1.0, 2.0])]
    rows += [(207, [1.0] * 4)] * 30 + [(None, [1.0] * 4)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(5)
    ids = [i for i, _ in rows if i is not None and (i % 20 == 0 or i >= 200)]
    got = topk.search(df, df.filter(df.vec_id.isin(ids)), k=5, query_bytes=query_bytes).collect()
    import numpy as np

    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert sorted(map(tuple, got)) == brute(exact, set(ids), 5)


def test_large_components(spark):
    rows = [(0, [2.0**40, 1.0]), (1, [2.0**40, -1.0]), (2, [-(2.0**40), 0.5]), (3, [1e300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in topk.search(df, df.filter("vec_id = 0")).collect()}
    assert got[0, 1] == topk.LONG and got[0, 2] == -topk.LONG and got[0, 3] == topk.LONG


def test_empty_tables(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>, score int")
    assert topk.search(df, df).count() == 0
