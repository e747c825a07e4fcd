import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tabwright.llm import quality
from tabwright.llm.base import crc_fold, strings


def plain(text: str) -> list[float]:
    """The statistics of one text, one by one."""
    b = text.encode()
    if not b:
        return [0.0] * len(quality.NAMES)
    words = re.findall(rb"[^\x20\x09-\x0D]+", b)
    low = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words]
    n, k = len(b), max(1, len(words))
    kind = [sum(c in s for c in b) for s in (
        range(97, 123), range(65, 91), range(48, 58), b" \t", b"\n\r", b".!?", b",;:'\"()-",
        [c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".!?,;:'\"()-"], range(128, 256), [*range(9), 11, 12, *range(14, 32), 127])]
    symbol = {c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".!?,;:'\"()-"}
    # a word may have control bytes inside: they do not add to its length
    length = [sum(c > 32 and c != 127 for c in w) for w in words]
    mean = sum(length) / k
    fours = [tuple(low[i : i + 4]) for i in range(len(low) - 3)]
    doubled = sum(x == y and (x in symbol or x in b".!?") for x, y in zip(b, b[1:]))
    return [
        math.log1p(n), math.log1p(len(words)), mean, math.sqrt(max(0.0, sum(x * x for x in length) / k - mean**2)), *[c / n for c in kind],
        -sum(c / n * math.log2(c / n) for c in Counter(b).values()), len(set(low)) / k, max(Counter(low).values(), default=0) / k,
        len(set(fours)) / max(1, len(fours)), sum(sum(65 <= c <= 90 for c in w) > 1 and not any(97 <= c <= 122 for c in w) for w in words) / k,
        sum(any(c in symbol for c in w) for w in words) / k, sum(65 <= w[0] <= 90 for w in words) / k, doubled / n,
        math.log1p(len(words) / (kind[5] + 1)), math.log1p(len(words) / (kind[4] + 1)),
    ]


def test_statistics_one_by_one():
    import pyarrow as pa

    rng = random.Random(1)
    texts = ["", " \n\t", "One two.", "SHOUT!! SHOUT!! a\x0bb\x7fc", "a b c d a b c d\n\n" * 30, "é 日本 ###$$$ ...", "x" * 5000, None]
    texts += ["".join(rng.choice("aB1 .,!#\n\té-") for _ in range(rng.randrange(200))) for _ in range(60)]
    got = quality.statistics(*strings(pa.array(texts)))
    assert np.allclose(got, [plain(t or "") for t in texts], atol=1e-9)
    assert got.shape[1] == len(quality.NAMES)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    words = ["".join(rng.choice(["ta", "re", "mo", "lin", "da", "so", "ver"]) for _ in range(rng.randrange(1, 4))) for _ in range(400)]
    rows, labels = [], []
    for i in range(900):
        w = [rng.choice(words) for _ in range(rng.randrange(20, 160))]
        good = i % 5 != 0
        if not good:
            w = [x.upper() + "!!" for x in w] if i % 2 else [x + rng.choice(["$$$", "###"]) for x in w]
        rows.append((i, " ".join(w).capitalize() + ".", "xx", "s", 0))
        labels.append((i, int(good)))
    return rows, labels


def test_held_out_accuracy(spark, docs_of, corpus):
    rows, labels = corpus
    table = spark.createDataFrame(labels + labels[:50] + [(None, 1), (5000, 1), (3, None), (4, 7)], "doc_id bigint, quality int")
    out = quality.classify(docs_of(rows), table).withColumn("held_out", crc_fold(quality.FOLDS) == 0).collect()
    truth = dict(labels)
    assert len(out) == len(rows)
    assert np.mean([truth[r.doc_id] == r.predicted for r in out if r.held_out]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)


def test_kernel_is_approximated():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((60, len(quality.NAMES)))
    z = quality.waves(x, np.zeros(x.shape[1]), np.ones(x.shape[1]))
    gap = ((x[:, None] - x[None]) ** 2).sum(axis=2) / (quality.WIDTH**2 * x.shape[1])
    assert np.abs(z @ z.T - np.exp(-gap / 2)).max() < 0.3
    assert np.abs(z @ z.T - np.exp(-gap / 2)).mean() < 0.06


def test_normal_equations_are_sums_over_all_rows(spark):
    rng = np.random.default_rng(1)
    x, y = rng.standard_normal((500, len(quality.NAMES))), rng.integers(0, 2, 500)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    rows = spark.createDataFrame([(a.tolist(), int(b)) for a, b in zip(x, y, strict=True)], "x array<double>, y int").repartition(7)
    gram, right = quality.normal_equations(rows, mean, scale, 0.4)
    z = quality.waves(x, mean, scale)
    assert np.allclose(gram, z.T @ z) and np.allclose(right, z.T @ (y - 0.4))


def test_calibration_never_falls():
    at, level = quality.calibrate(np.array([0.1, 0.2, 0.3, 0.4]), np.array([10.0, 10, 10, 10]), np.array([1.0, 4, 2, 9]), 0.5)
    assert np.allclose(at, [0.1, 0.25, 0.4])
    assert np.allclose(level, [2 / 12, 7 / 22, 10 / 12])


def test_odd_rows(spark, docs_of, corpus, odd_rows):
    rows, labels = corpus
    rows, labels = [(r[0] + 1000, *r[1:]) for r in rows], [(i + 1000, y) for i, y in labels]
    table = spark.createDataFrame(labels, "doc_id bigint, quality int")
    docs = docs_of([(*r, 3, "x", [1.0]) for r in odd_rows + rows], ", score int, quality string, x array<double>")
    out = quality.classify(docs, table).collect()
    assert len(out) == len(odd_rows) + len(rows) and {r.predicted for r in out} == {0, 1}
    for same in ([1, 2], [4]):
        assert len({r.score for r in out if r.doc_id in same}) == 1
    assert quality.classify(docs_of([]), table).count() == 0


@pytest.mark.filterwarnings("ignore:quality")
def test_without_both_classes(spark, docs_of):
    docs = docs_of([(i, f"text {i}", "en", "s", 0) for i in range(20)])
    for labels in ([], [(i, 1) for i in range(20)], [(1, None)]):
        out = quality.classify(docs, spark.createDataFrame(labels, "doc_id bigint, quality int")).collect()
        assert {(r.score, r.predicted) for r in out} == {(0.5, 1)} and len(out) == 20
