import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabwright.operators import split as S
from tabwright.operators import transforms as P
from tabwright.operators.joins import lookup
from tabwright.plans.contracts import CHURN

PLAN = {"feature1": "scale", "feature2": "onehot", "feature3": "scale", "target": "target"}


@pytest.fixture
def small(spark):
    rows = [(i, float(i + 1), v, float(10 * (i + 1)), float(i % 2)) for i, v in enumerate("ABACB")]
    return spark.createDataFrame(rows, "id bigint, feature1 double, feature2 string, feature3 double, target double")


def features(df):
    return [list(r["v"]) for r in df.orderBy("id").select(vector_to_array("features").alias("v")).collect()]


def test_numeric_fit_uses_population_deviation_after_imputation(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,), (5.0,)], "x double")
    r = P.fit_numeric(df, ["x"]).first()
    filled = [1, 2, 3, 2.75, 5]
    mu = sum(filled) / 5
    sd = (sum((v - mu) ** 2 for v in filled) / 5) ** 0.5
    assert (r["fill"], r["mean"]) == (2.75, pytest.approx(mu)) and r["std"] == pytest.approx(sd)
    z = [r["x_z"] for r in P.scale_columns(df, P.fit_numeric(df, ["x"]), ["x"]).collect()]
    assert None not in z and sum(z) == pytest.approx(0, abs=1e-9)


@pytest.mark.parametrize("strategy, fill", [("mean", 2.75), ("median", 2.5), ("most_frequent", 2.0), ("zero", 0.0)])
def test_imputer_strategies(spark, strategy, fill):
    df = spark.createDataFrame([(2.0,), (2.0,), (3.0,), (None,), (4.0,)], "x double")
    r = P.fit_numeric(df, ["x"], strategy).first()
    assert r["fill"] == fill
    vals = [2, 2, 3, fill, 4]
    assert r["mean"] == pytest.approx(sum(vals) / 5)


def test_constant_column_is_divided_by_one(spark):
    df = spark.createDataFrame([(7.0,), (7.0,)], "x double")
    assert P.fit_numeric(df, ["x"]).first()["std"] == 1.0


def test_unknown_strategy(spark):
    with pytest.raises(ValueError, match="unknown strategy"):
        P.fill_values(None, {"x": "guess"})


def test_pipeline_on_the_small_table(spark, small):
    p = P.fit_preprocessing(small, PLAN, "target")
    v = features(p.transform(small))
    assert len(v[0]) == 5 == p.width
    assert all(sum(r[1:4]) == 1 for r in v)  # one-hot block in plan order
    assert [r[0] for r in v] == pytest.approx([-1.41421356, -0.70710678, 0, 0.70710678, 1.41421356])
    assert p.info() == [("feature1", "scale", None), ("feature2", "onehot", 3), ("feature3", "scale", None)]


@pytest.mark.parametrize("unknown, block", [("zeros", [0.0, 0.0]), ("train_mode", [1.0, 0.0])])
def test_unknown_and_null_categories(spark, unknown, block):
    train = spark.createDataFrame([(0, "A", 0), (1, "A", 1), (2, "B", 0)], "id bigint, c string, target int")
    new = spark.createDataFrame([(0, "D"), (1, None), (2, "B")], "id bigint, c string")
    p = P.fit_preprocessing(train, {"c": "onehot"}, "target", unknown=unknown)
    assert features(p.transform(new)) == [block, block, [0.0, 1.0]]


def test_batch_mode_takes_the_mode_of_the_batch(spark):
    train = spark.createDataFrame([("A",), ("A",), ("B",), ("C",)], "c string")
    new = spark.createDataFrame([(0, "D"), (1, "B"), (2, "B"), (3, None), (4, "A")], "id bigint, c string")
    voc = P.vocabulary(P.category_counts(train, ["c"]))
    got = {r["id"]: (r["value"], r["code"]) for r in P.encode_long(new, "id", ["c"], voc, "batch_mode").collect()}
    assert got[0] == ("B", 1) and got[3] == ("B", 1) and got[4] == ("A", 0)
    # an unknown value that is its own batch mode has no slot
    lone = spark.createDataFrame([(0, "D")], "id bigint, c string")
    assert P.encode_long(lone, "id", ["c"], voc, "batch_mode").first()["code"] is None
    # a batch without any value falls back to the first class
    empty = spark.createDataFrame([(0, None)], "id bigint, c string")
    assert P.encode_long(empty, "id", ["c"], voc, "batch_mode").first()["code"] == 0


def test_integer_vocabulary_sorts_as_numbers(spark):
    df = spark.createDataFrame([(2,), (10,), (1,)], "n bigint")
    voc = P.vocabulary(P.category_counts(df, ["n"]), ["n"]).orderBy("code").collect()
    assert [r["value"] for r in voc] == ["1", "2", "10"]


def test_fold_statistics_ignore_the_own_fold(spark):
    rows = [(i, float(i * i % 17) if i % 5 else None, "ABC"[i % 3], i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, x double, c string, target int")
    f = S.assign_folds(df, "id", 3).cache()
    whole = P.fold_numeric(f, ["x"])
    direct = {i: P.fit_numeric(S.train_part(f, i), ["x"]).first() for i in range(3)}
    for r in whole.collect():
        d = direct[r["fold"]]
        assert r["mean"] == pytest.approx(d["mean"]) and r["std"] == pytest.approx(d["std"])
        assert r["fill"] == pytest.approx(d["fill"])
    # spoiling the validation rows changes nothing that was fitted for that fold
    bad = f.withColumn("x", F.when(F.col("fold") == 1, 1e6).otherwise(F.col("x"))).withColumn(
        "c", F.when(F.col("fold") == 1, "Z").otherwise(F.col("c"))
    )
    a = P.fit_folds(f, {"x": "scale", "c": "onehot"}, "target", 3)[1]
    b = P.fit_folds(bad, {"x": "scale", "c": "onehot"}, "target", 3)[1]
    assert a.numeric["x"] == pytest.approx(b.numeric["x"]) and a.sizes == b.sizes and a.mode == b.mode
    assert sorted(a.table.collect()) == sorted(b.table.collect())


def test_target_checks(spark):
    ok = spark.createDataFrame([(0.0,), (1.0,), (None,)], "t double")
    assert [r["label"] for r in P.target_column(ok, "t", "zero").collect()] == [0, 1, 0]
    assert P.target_column(ok, "t", "drop").count() == 2
    with pytest.raises(Exception, match="missing values"):
        P.target_column(ok, "t").select("label").collect()
    bad = spark.createDataFrame([(0,), (2,)], "t int")
    with pytest.raises(ValueError, match="Target must contain only 0 and 1"):
        P.check_target(bad, "t")
    with pytest.raises(Exception, match="only 0 and 1"):
        P.target_column(bad, "t").select("label").collect()


def test_selector(spark, small):
    assert P.select_features(small, ["feature1", "feature2"]).columns == ["feature1", "feature2"]
    with pytest.raises(ValueError, match="lacks features"):
        P.select_features(small, ["feature1", "nope"])
    with pytest.raises(ValueError, match="no decision"):
        P.action_of(PLAN, "nope")


def test_transform_before_fit(spark, small):
    with pytest.raises(ValueError, match="fitted plan"):
        P.Preprocessing(PLAN, {}, {}, {}).transform(small)
    with pytest.raises(ValueError, match="uses no feature"):
        P.fit_preprocessing(small, {"feature1": "drop"}, "target")


def test_saved_pipeline_gives_the_same_vectors(spark, small, tmp_path):
    p = P.fit_preprocessing(small, PLAN, "target")
    p.stages.write().overwrite().save(str(tmp_path / "prep"))
    back = PipelineModel.load(str(tmp_path / "prep"))
    assert features(back.transform(small)) == features(p.transform(small))


def test_contract_policy(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0), (None, None, 1), (4.0, 9.0, 0), (10.0, 2.0, 1)], "acctbal double, avg_total double, churn int")
    p = P.fit_preprocessing(df, {"acctbal": "scale", "avg_total": "scale"}, "churn", "contract", CHURN)
    assert p.numeric["acctbal"][0] == 0.0 and p.numeric["avg_total"][0] == 2.0


def test_hashing_is_an_action_of_its_own(spark):
    df = spark.createDataFrame([(i, f"v{i}", i % 2) for i in range(50)], "id bigint, c string, target int")
    p = P.fit_preprocessing(df, {"c": "hash"}, "target", hash_size=128)
    v = features(p.transform(df))
    assert p.hashed == ["c"] and all(len(r) == 128 and sum(map(abs, r)) == 1 for r in v)
    p = P.fit_preprocessing(df, {"c": "embed"}, "target")
    assert p.width == 50 and all(sum(r) == 1 for r in features(p.transform(df)))


def test_feature_without_values_keeps_its_block(spark):
    df = spark.createDataFrame([(i, None, None, "ab"[i % 2], i % 2) for i in range(10)], "id bigint, c string, t string, d string, target int")
    plan = {"c": "onehot", "d": "onehot", "t": "target_encode"}
    p = P.fit_preprocessing(df, plan, "target")
    assert p.width == 4 and [f for f, *_ in p.info()] == ["c", "d", "t"]
    assert {tuple(r) for r in features(p.transform(df))} == {(0.0, 1.0, 0.0, 0.5), (0.0, 0.0, 1.0, 0.5)}
    f = S.assign_folds(df, "id", 2)
    assert [q.width for q in P.fit_folds(f, plan, "target", 2)] == [4, 4]


def test_lookup_equals_a_left_join_with_hot_and_null_keys(spark):
    keys = ["hot"] * 300 + [None] * 50 + [f"k{i}" for i in range(100)] + ["absent"] * 5
    rows = spark.createDataFrame(list(enumerate(keys)), "id bigint, k string")
    t = rows.filter("k IS NOT NULL AND k <> 'absent'").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("m"))
    got = {r["id"]: r["m"] for r in lookup(rows, t, ["k"], "n", "id").collect()}
    want = {r["id"]: r["m"] for r in rows.join(t, "k", "left").collect()}
    assert got == want and len(got) == len(keys)


@pytest.mark.parametrize("buckets", [1, 8, 50])
def test_vocabulary_codes_for_any_bucketing(spark, buckets, monkeypatch):
    monkeypatch.setattr(P, "bucket_target", lambda spark, rows=0: buckets)
    words = [f"Customer#{i:05d}" for i in range(0, 900, 7)] + ["Customer#", "Customer#é", "Customer#00007x"]
    nums = [5, -3, 100, 20, 7]
    rows = [("w", w, 1) for w in words] + [("n", str(n), 2) for n in nums] + [("one", "x", 1)]
    df = spark.createDataFrame(rows, "feature string, value string, n bigint")
    got = {(r["feature"], r["value"]): r["code"] for r in P.vocabulary(df, ["n"]).collect()}
    for i, w in enumerate(sorted(words, key=lambda s: s.encode())):
        assert got[("w", w)] == i
    for i, n in enumerate(sorted(nums)):
        assert got[("n", str(n))] == i
    assert got[("one", "x")] == 0 and len(got) == len(rows)


def test_target_encoded_feature_in_a_pipeline(spark):
    rows = [(i, ["it's", "b\\c", "d"][i % 3], int(i % 3 == 0 or i % 5 == 0)) for i in range(30)]
    df = spark.createDataFrame(rows, "id bigint, c string, target int")
    p = P.fit_preprocessing(df, {"c": "target_encode"}, "target")
    mean = {v: sum(t for _, w, t in rows if w == v) / 10 for v in ("it's", "b\\c", "d")}
    assert [r[0] for r in features(p.transform(df))] == pytest.approx([mean[v] for _, v, _ in rows])
    new = spark.createDataFrame([(0, "zzz"), (1, None)], "id bigint, c string")
    prior = sum(t for *_, t in rows) / 30
    assert [r[0] for r in features(p.transform(new))] == pytest.approx([prior, prior])
    assert p.info() == [("c", "target_encode", 3)] and p.width == 1
    f = S.assign_folds(df, "id", 3).cache()
    per_fold = P.fit_folds(f, {"c": "target_encode"}, "target", 3)
    for i, q in enumerate(per_fold):
        direct = P.fit_preprocessing(S.train_part(f, i), {"c": "target_encode"}, "target")
        means = [{r["value"]: r["mean"] for r in x.table.collect()} for x in (q, direct)]
        assert means[0] == pytest.approx(means[1]) and len(means[0]) == 3
        assert q.encoded["c"] == pytest.approx(direct.encoded["c"])


def test_buckets_are_even_for_values_with_a_common_beginning(spark, monkeypatch):
    monkeypatch.setattr(P, "bucket_target", lambda spark, rows=0: 16)
    rows = [("u", f"https://www.example.com/{i:06d}", 1) for i in range(4000)] + [("u", "ftp://x", 1)]
    df = spark.createDataFrame(rows, "feature string, value string, n bigint")
    sizes = []
    plain = P.rank.cumulate

    def spy(counts, by, order, bucket, *a, **k):
        sizes.extend(r["count"] for r in counts.groupBy(bucket).count().collect())
        return plain(counts, by, order, bucket, *a, **k)

    monkeypatch.setattr(P.rank, "cumulate", spy)
    got = {r["value"]: r["code"] for r in P.vocabulary(df).collect()}
    assert [got[v] for v in sorted(v for _, v, _ in rows)] == list(range(4001))
    assert max(sizes) < 3 * 4001 / 16


@pytest.mark.parametrize("limit", [0, 1 << 22])
def test_classes_are_a_table(spark, tmp_path, monkeypatch, limit):
    """By broadcast and by lookup, with hot, null, unknown and odd values, saved and read again, and per fold."""
    from tabwright.operators import classes

    monkeypatch.setattr(classes, "BROADCAST_BYTES", limit)
    words = ["hot"] * 60 + [None] * 20 + [f"w'{i}\\\n" for i in range(40)]
    rows = [(i, w, i % 7, int(i % 3 == 0), [1]) for i, w in enumerate(words)]
    df = spark.createDataFrame(rows, "id bigint, c string, d int, target int, extra array<int>")
    plan = {"c": "target_encode", "d": "onehot"}
    p = P.fit_preprocessing(df, plan, "target", unknown="zeros")
    assert p.width == 8 and p.info() == [("c", "target_encode", 41), ("d", "onehot", 7)]
    by = {}
    for _, w, _, t, _ in rows:
        by.setdefault(w, []).append(t)
    prior = sum(r[3] for r in rows) / len(rows)
    new = spark.createDataFrame([(1, "never", 99, 0, [1]), (2, None, None, 0, [1])], df.schema)
    want = {r[0]: [prior if r[1] is None else sum(by[r[1]]) / len(by[r[1]]), *[float(k == r[2]) for k in range(7)]] for r in rows}
    p.stages.write().overwrite().save(str(tmp_path / "prep"))
    for stages in (p, PipelineModel.load(str(tmp_path / "prep"))):
        got = {r["id"]: r["features"].toArray().tolist() for r in stages.transform(df).collect()}
        assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i]) for i in want)
        assert [f == pytest.approx([prior] + [0.0] * 7) for f in features(stages.transform(new))] == [True, True]
        assert stages.transform(df).columns == [*df.columns, "features"]
    folds = P.fit_folds(S.assign_folds(df, "id", 3), plan, "target", 3)
    assert [q.sizes["d"] for q in folds] == [7, 7, 7] and len({q.path for q in folds}) == 1
