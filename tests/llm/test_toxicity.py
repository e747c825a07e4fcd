import random

import numpy as np
import pytest

from tabwright.llm import toxicity
from tabwright.llm.base import crc_fold

RUDE = ["zorbag", "flimnak", "gruddle", "wexpot"]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    words = ["".join(rng.choice(["ta", "re", "mo", "lin", "da", "so", "ver"]) for _ in range(rng.randrange(1, 4))) for _ in range(400)]
    rows, labels = [], []
    for i in range(900):
        w = [rng.choice(words) for _ in range(rng.randrange(40, 160))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(max(2, len(w) // 25)):
                w[rng.randrange(len(w))] = rng.choice(RUDE)
        rows.append((i, " ".join(w).capitalize() + ".", "xx", "s", 0))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark, docs_of, corpus):
    rows, labels = corpus
    docs = docs_of(rows)
    table = spark.createDataFrame(labels + labels[:50] + [(None, 1), (5000, 1), (3, None)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, table)
    out = toxicity.score(docs, model).withColumn("held_out", crc_fold(toxicity.FOLDS) == 0)
    truth = dict(labels)
    got = [(truth[r.doc_id], r.score, r.predicted) for r in out.collect() if r.held_out]
    pos, neg = [s for t, s, _ in got if t], [s for t, s, _ in got if not t]
    assert np.mean([[a > b for b in neg] for a in pos]) > 0.97
    assert sum(t == p for t, _, p in got) / len(got) > 0.95
    assert all(0 <= s <= 1 and p == (s >= 0.5) for _, s, p in got)
    # nothing but the text counts
    moved = docs_of([(i + 7, t, "yy", "other", 1) for i, t, *_ in rows[:40]])
    plain = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all(plain[r.doc_id - 7] == r.score for r in toxicity.score(moved, model).collect())


def test_odd_rows(docs_of, corpus, spark, odd_rows):
    rows, labels = corpus
    model = toxicity.train(docs_of(rows), spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    docs = docs_of([(*r, 3, "x") for r in odd_rows], ", score int, predicted string")
    out = toxicity.score(docs, model)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "predicted", "n_windows"]
    got = out.collect()
    assert len(got) == len(odd_rows)
    assert len({r.score for r in got if r.n_windows == 0}) == 1
    assert all(r.predicted == 0 for r in got)


def test_without_labels_every_score_is_zero(docs_of, spark):
    docs = docs_of([(1, "a b c", "en", "s", 0)])
    for labels in ([], [(1, 1)], [(1, None)]):
        model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
        assert model is None
    assert [(r.score, r.predicted) for r in toxicity.score(docs, None).collect()] == [(0.0, 0)]
    assert toxicity.score(docs_of([]), None).count() == 0


def test_rising():
    assert toxicity.rising(np.array([1.0, 3.0, 2.0, 5.0]), np.ones(4)).tolist() == [1.0, 2.5, 2.5, 5.0]
    assert toxicity.rising(np.array([3.0, 2.0, 1.0]), np.array([1.0, 1.0, 2.0])).tolist() == [1.75] * 3


def test_verdict_equals_score(spark, docs_of, corpus, odd_rows):
    rows, labels = corpus
    model = toxicity.train(docs_of(rows), spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    docs = docs_of(rows[:200] + odd_rows)
    for m in (model, None):
        got = docs.withColumn("v", toxicity.verdict(docs["text"], m)).select("doc_id", "v").collect()
        assert sorted(map(str, got)) == sorted(str(r).replace("score", "v") for r in toxicity.score(docs, m).select("doc_id", "score").collect())
