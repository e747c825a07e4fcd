import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import mixing


def brute(mass, targets, rounds=3000):
    t = mass / mass.sum()
    for _ in range(rounds):
        for axis, goal in enumerate(targets):
            for i, g in enumerate(goal):
                at = [slice(None)] * t.ndim
                at[axis] = i
                s = t[tuple(at)].sum()
                if s > 0:
                    t[tuple(at)] *= g / s
    return t


def test_fit_equals_plain_raking():
    rng = np.random.default_rng(1)
    mass = rng.random((4, 3, 2)) * 100
    targets = [np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.5, 0.3, 0.2]), np.array([0.7, 0.3])]
    t = mixing.fit(mass, targets)
    assert np.allclose(t, brute(mass, targets), atol=1e-8)
    for axis, goal in enumerate(targets):
        assert np.allclose(t.sum(axis=tuple(i for i in range(3) if i != axis)), goal, atol=1e-9)


def test_full_cells_are_made_up_for_by_others():
    mass = np.array([[1.0, 9.0], [40.0, 50.0]])
    targets, cap = [np.array([0.15, 0.85]), np.array([0.5, 0.5])], mass / 100 / 0.6
    t = mixing.fit(mass, targets, cap)
    assert (t <= cap + 1e-12).all()
    assert np.allclose(t.sum(axis=1), targets[0], atol=1e-6) and np.allclose(t.sum(axis=0), targets[1], atol=1e-6)


@pytest.fixture(scope="module")
def many(spark):
    source = F.concat(F.lit("s"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7))
    lang = F.when(F.xxhash64("id") % 5 == 0, "de").otherwise("en")
    text = F.repeat(F.lit("word "), (F.col("id") % 40 + 1).cast("int"))
    return spark.range(6000).select(F.col("id").alias("doc_id"), text.alias("text"), lang.alias("lang"), source.alias("source"), (F.col("id") % 2).alias("topic"))


def test_sample_has_the_target_shares(many):
    targets = {"source": 0.5, "lang": {"de": 0.4, "en": 0.6}, "topic": {"0": 0.5, "1": 0.5}}
    out = mixing.mix(many, targets, share=0.4).toPandas()
    assert len(out) == 6000
    weighed = out.n_tokens * out.probability
    for c in ("lang", "topic"):
        got = weighed.groupby(out[c].astype(str)).sum() / weighed.sum()
        for v, g in targets[c].items():
            assert got[v] == pytest.approx(g, abs=1e-6)
    kept = out[out.kept]
    assert kept.n_tokens.sum() / out.n_tokens.sum() == pytest.approx(0.4, abs=0.03)
    assert (kept[kept.lang == "de"].n_tokens.sum() / kept.n_tokens.sum()) == pytest.approx(0.4, abs=0.03)
    again = mixing.mix(many.repartition(7), targets, share=0.4).filter("kept").toPandas()
    assert sorted(again.doc_id) == sorted(kept.doc_id)


def test_values_without_a_target_share_the_rest(many):
    out = mixing.mix(many, {"source": {"s1": 0.3}, "lang": {"en": 0.5, "de": 0.5}}, share=0.3).toPandas()
    weighed = out.n_tokens * out.probability
    assert weighed[out.source == "s1"].sum() / weighed.sum() == pytest.approx(0.3, abs=1e-6)


def test_unnamed_values_stay_when_the_named_shares_sum_to_one(many):
    out = mixing.mix(many, {"source": 0.5, "lang": {"en": 1.0}}, share=0.4).toPandas()
    weighed = out.n_tokens * out.probability
    observed = out.n_tokens[out.lang == "de"].sum() / out.n_tokens.sum()
    assert weighed[out.lang == "de"].sum() / weighed.sum() == pytest.approx(observed, abs=1e-6)
    assert out.kept[out.lang == "de"].any()


def test_many_values_are_raked_as_a_table(many, monkeypatch):
    targets = {"source": 0.5, "lang": {"de": 0.4, "en": 0.6}, "topic": {"0": 0.5, "1": 0.5}}
    want = mixing.mix(many, targets, share=0.4).toPandas().set_index("doc_id").probability
    monkeypatch.setattr(mixing, "MAX_VALUES", 3)
    got = mixing.mix(many, targets, share=0.4).toPandas().set_index("doc_id").probability
    assert len(got) == len(want) and (got - want).abs().max() < 1e-4


def test_odd_rows(docs_of, odd_rows):
    docs = docs_of([(*r, 1, "x") for r in odd_rows], ", kept int, weight string")
    out = mixing.mix(docs, {"source": 0.5, "lang": 0.5}, share=0.5)
    rows = out.collect()
    assert len(rows) == len(odd_rows)
    assert all(0 <= r.probability <= 1 and r.kept is not None for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert len({r.kept for r in rows if r.doc_id == 4}) == 1
    assert mixing.mix(docs_of([]), {"source": 0.5, "lang": {"en": 1.0}}).count() == 0


def test_tokens_and_topics(spark):
    df = spark.createDataFrame([("a b\tc\n",), ("",), ("Copyright x",), ("w*** " * 50,)], "text string")
    got = [tuple(r) for r in df.select(mixing.n_tokens(F.col("text")), mixing.topic_of(F.col("text"))).collect()]
    assert got == [(3, "note"), (0, "empty"), (2, "license"), (50, "noise")]
