import pytest
from pyspark.sql import functions as F

from tabwright.operators import features as L
from tabwright.operators import profile as D
from tabwright.operators import validate as V
from tabwright.plans.contracts import CHURN
from tabwright.sources import synth
from tabwright.streaming import score as ST


def test_products_are_whitelisted(spark):
    df = spark.createDataFrame([(2, 3.0)], "a int, b double")
    assert L.interactions(df, ["a * b"]).first()["a_x_b"] == 6.0
    with pytest.raises(ValueError, match="not a product"):
        L.interactions(df, ["a + b"])
    with pytest.raises(ValueError, match="not in the table"):
        L.interactions(df, ["a * c"])


def test_ratio_and_bins(spark):
    df = spark.createDataFrame([(1, 0), (1, 2), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(L.ratio("a", "b")).collect()] == [None, 0.5, None]
    assert [r[0] for r in df.select(L.bin_label("b", [1], ["low", "high"])).collect()] == ["low", "high", "high"]
    with pytest.raises(ValueError):
        L.bin_label("b", [1], ["low"])


@pytest.mark.parametrize("small", [2, 64])
def test_percentile_rank_averages_ties(spark, small, monkeypatch):
    from tabwright.operators import rank

    monkeypatch.setattr(rank, "bucket_target", lambda spark, rows=0: small)
    df = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 2.0), (3, 5.0), (4, None)], "id int, x double")
    got = {r["id"]: r["percentile"] for r in L.percentile_rank(df, "x", "id").collect()}
    assert got == {0: 0.25, 1: 0.625, 2: 0.625, 3: 1.0, 4: None}


def test_month_history(spark):
    df = spark.createDataFrame([("k", m, v) for m, v in ((0, 1.0), (1, 2.0), (3, 7.0))], "k string, month bigint, v double")
    out = L.month_history(df, "k", [("v", 3)], [("v", 2)], [("v", 3)]).orderBy("month").collect()
    assert [r["avg_v_3m"] for r in out] == [1.0, 1.5, 4.5]
    assert [r["max_v_2m"] for r in out] == [1.0, 2.0, 7.0]
    assert [r["trend_v_3m"] for r in out] == [None, 1.0, pytest.approx(2.5)]


def test_synthetic_customers(spark):
    a = synth.generate(spark, 50, 7).orderBy("customer_id").collect()
    b = synth.generate(spark, 50, 7).repartition(6).orderBy("customer_id").collect()
    assert a == b and a != synth.generate(spark, 50, 8).orderBy("customer_id").collect()
    df = synth.generate(spark, 3000).cache()
    assert len(df.columns) == 23 and df.first()["customer_id"].startswith("CUST_")
    r = df.agg(
        F.avg("churn_probability").alias("rate"), F.min("age").alias("lo"), F.max("age").alias("hi"),
        F.avg("page_views_total").alias("pages"), F.avg("email_opens_count").alias("opens"), F.var_pop("email_opens_count").alias("var"),
        F.avg(F.col("support_tickets_avg_resolution_days").isNull().cast("int")).alias("holes"),
        F.count_if((F.col("churn_probability") == 0) & F.col("churn_date").isNotNull()).alias("early"),
        F.count_if(F.col("page_views_total") > 50 * 2 + 100).alias("far"),
    ).first()
    assert 0.15 < r["rate"] < 0.4 and r["lo"] >= 18 and r["hi"] <= 80
    assert 35 < r["pages"] < 75 and 2.8 < r["opens"] < 3.2 and 2.6 < r["var"] < 3.4
    assert 0.07 < r["holes"] < 0.13 and r["early"] == 0 and r["far"] == 0


def test_poisson_table():
    cdf = synth.poisson_cdf(0.5)
    assert cdf[0] == pytest.approx(0.6065306597) and cdf[-1] == pytest.approx(1.0)
    assert len(synth.poisson_cdf(100.0)) == 240


def test_constant_and_holed_correlations(spark):
    rows = [(float(i), float(2 * i), 1.0, float(i) if i % 2 else None, float(-i * i)) for i in range(20)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    got = {(r["a"], r["b"]): r["corr"] for r in V.correlation_pairs(df, ["a", "b", "c", "d", "e"]).collect()}
    assert got[("a", "b")] == pytest.approx(1.0) and got[("a", "c")] is None and got[("a", "d")] == pytest.approx(1.0)
    pdf = df.toPandas()
    assert got[("d", "e")] == pytest.approx(pdf["d"].corr(pdf["e"])) and got[("a", "e")] == pytest.approx(pdf["a"].corr(pdf["e"]))
    assert V.drop_correlated(df, ["a", "b", "e"], 0.95) == ["a"] or V.drop_correlated(df, ["a", "b", "e"], 0.95) == ["a", "e"]


def test_decision_rules_by_type_and_size(spark):
    rows = [("id", "string", 500, False), ("g", "string", 3, False), ("m", "string", 30, False), ("n", "bigint", 4, False),
            ("w", "bigint", 21, False), ("x", "double", 2, False), ("t", "date", 9, False), ("l", "string", 5, True)]
    df = spark.createDataFrame([(*r[:3], 0, 0.0, r[3], not r[3]) for r in rows], "feature string, dtype string, nunique bigint, missing_count bigint, missing_pct double, is_leaky boolean, is_training boolean")
    got = {r["name"]: r["action"] for r in D.decide(df).collect()}
    assert got == {"id": "embed", "g": "onehot", "m": "target_encode", "n": "onehot", "w": "scale", "x": "scale", "t": "investigate", "l": "drop"}


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    got = {r["bin"]: r["n"] for r in D.histogram(df, ["x"], 5).collect()}
    assert got == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    flat = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert D.histogram(flat, ["x"], 4).first()["n"] == 2


def test_frame_contract_is_complete():
    assert len(CHURN.training()) == 9 and CHURN.leaky() == ["post_orders", "first_post_date"]


def test_stream_resumes_without_repeats(spark, tmp_path):
    src, out, check = (str(tmp_path / d) for d in ("src", "out", "check"))
    spark.range(0, 50).write.parquet(src + "/a")
    schema = "id bigint"

    def go():
        stream = spark.readStream.schema(schema).parquet(src + "/*")
        ST.score_stream(stream, lambda d: d.withColumn("p", F.col("id") / 100.0), out, check).awaitTermination()
        return spark.read.parquet(out)

    assert go().count() == 50
    spark.range(50, 80).write.parquet(src + "/b")
    assert sorted(r["id"] for r in go().collect()) == list(range(80))


def test_stream_windows_count_every_event_once(spark, tmp_path):
    src = str(tmp_path / "ev")
    rows = spark.range(100).select(
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.expr("make_dt_interval(0, CAST(id AS INT))")).alias("ts"),
        F.lit("k").alias("kind"), F.lit(1.0).alias("value"),
    )
    rows.repartition(5).write.parquet(src)
    w = ST.usage_windows(ST.table_stream(spark, src, files_per_batch=1), "ts", ["kind"], late="30 days")
    ST.write_batches(w, str(tmp_path / "o"), str(tmp_path / "c"), "update").awaitTermination()
    last = ST.latest_state(spark, str(tmp_path / "o"), ["start", "kind"]).collect()
    assert sum(r["n"] for r in last) == 100 and len(last) == 5


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_wall_clock_round_trip_in_any_zone(spark, zone):
    from tabwright.functions.scalar import as_instant, as_wall_clock

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # hours that New York skips or repeats are among them
        texts = ["2024-03-10 02:30:00.000001", "2024-11-03 01:30:00", "1969-12-31 23:59:59.999999", "2024-01-01 00:00:00"]
        df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.col("t").cast("timestamp_ntz").alias("n"))
        out = df.select("n", as_wall_clock(as_instant("n")).alias("b"), F.unix_micros(as_instant("n")).alias("u")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert all(r["n"] == r["b"] for r in out)
    assert out[2]["u"] == -1 and out[3]["u"] == 1704067200000000
