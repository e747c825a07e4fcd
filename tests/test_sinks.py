import pytest

from tabwright.sources import sinks, synth


def test_a_run_written_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "oof")

    def rows(run, model, n):
        return spark.createDataFrame([(run, model, i, 0, 1, 0.5, 0.5) for i in range(n)], "run string, model string, key bigint, fold int, y_true int, prob double, prob_cal double")

    sinks.write_oof(rows("r1", "a", 4).union(rows("r1", "b", 3)), path)
    sinks.write_oof(rows("r2", "a", 2), path)
    sinks.write_oof(rows("r1", "a", 5), path)
    found = {(r["run"], r["model"]): r["count"] for r in spark.read.parquet(path).groupBy("run", "model").count().collect()}
    assert found == {("r1", "a"): 5, ("r1", "b"): 3, ("r2", "a"): 2}
    sinks.write_oof(rows("r2", "a", 2), path, "append")
    assert spark.read.parquet(path).filter("run = 'r2'").count() == 4


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_saved_sample(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    n, rate = synth.save_sample(spark, path, 200, 3, fmt)
    want = synth.generate(spark, 200, 3)
    assert n == 200 and rate == pytest.approx(want.agg({"churn_probability": "avg"}).first()[0])
    if fmt == "csv":
        assert spark.read.option("header", True).csv(path).columns == want.columns
    with pytest.raises(ValueError):
        synth.save_sample(spark, path, 1, fmt="xml")
