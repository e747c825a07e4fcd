import pytest
import yaml

from tabwright.operators import validate as V
from tabwright.sources import readers
from tabwright.sources.contract import Contract

SPEC = {
    "features": {
        "customer_id": {"type": "string", "missing_policy": "forbidden", "leaky": False},
        "age": {"type": "integer", "missing_policy": "impute_median", "leaky": False},
        "gender": {"type": "categorical", "categories": ["M", "F", "Other"], "missing_policy": "impute_mode", "leaky": False},
        "revenue": {"type": "float", "missing_policy": "impute_zero", "leaky": False},
        "leaky_feature": {"type": "string", "missing_policy": "forbidden", "leaky": True},
    },
    "target": {"churn": {"type": "float", "range": [0.0, 1.0], "missing_policy": "forbidden"}},
    "constraints": {"max_missing_percentage": 0.3},
}
HEAD = "customer_id,age,gender,revenue,leaky_feature,churn"
GOOD = ["CUST_001,25,M,100.0,leak1,0.0", "CUST_002,30,F,150.0,leak2,1.0", "CUST_003,35,M,200.0,leak3,0.0"]


@pytest.fixture
def contract(tmp_path):
    path = tmp_path / "contract.yaml"
    path.write_text(yaml.safe_dump(SPEC, sort_keys=False))
    return Contract.load(str(path))


def put(tmp_path, rows, head=HEAD):
    path = tmp_path / "data.csv"
    path.write_text("\n".join([head, *rows]) + "\n")
    return str(path)


def test_valid_table_loads_with_declared_types(spark, contract, tmp_path):
    with pytest.warns(UserWarning, match="leaky"):
        df = readers.read(spark, put(tmp_path, GOOD), contract)
    assert df.count() == 3
    with pytest.warns(UserWarning, match="leaky"):
        assert readers.load_data(spark, put(tmp_path, GOOD), str(tmp_path / "contract.yaml")).collect() == df.collect()
    assert dict(df.dtypes)["age"] == "bigint" and dict(df.dtypes)["churn"] == "double"


def test_accessors(contract):
    assert contract.leaky() == ["leaky_feature"]
    assert contract.training() == ["customer_id", "age", "gender", "revenue"]
    assert contract.target_name == "churn"
    assert contract.schema()["gender"].metadata["categories"] == ["M", "F", "Other"]
    assert set(contract.info()) == {"features", "target", "constraints", "feature_engineering"}


def test_missing_files(spark, contract, tmp_path):
    with pytest.raises(FileNotFoundError):
        Contract.load(str(tmp_path / "no.yaml"))
    with pytest.raises(FileNotFoundError):
        readers.read(spark, str(tmp_path / "no.csv"), contract)


@pytest.mark.parametrize(
    "rows, head, message",
    [
        (["CUST_001,25"], "customer_id,age", "Missing required columns"),
        (["CUST_001,old,M,1.0,l,0.0"], HEAD, "should be integer type"),
        ([",25,M,1.0,l,0.0", GOOD[1]], HEAD, "'customer_id' has 1 missing values but missing_policy is 'forbidden'"),
        (["CUST_001,25,InvalidGender,1.0,l,0.0"], HEAD, "has invalid categories"),
        (["CUST_001,25,M,1.0,l,1.5"], HEAD, "values outside expected range"),
    ],
)
@pytest.mark.filterwarnings("ignore::UserWarning")
def test_violations_raise(spark, contract, tmp_path, rows, head, message):
    with pytest.raises(ValueError, match=message):
        readers.read(spark, put(tmp_path, rows, head), contract)


def test_report_mode_lists_everything_in_order(spark, contract, tmp_path):
    rows = ["CUST_001,x,Nope,1.0,l,2.0", ",26,M,NaN,,0.0"]
    _, bad = readers.read(spark, put(tmp_path, rows), contract, mode="report")
    got = [(r["column"], r["rule"]) for r in bad.orderBy("phase", "position", "step").collect() if r["severity"] == "error"]
    assert got == [
        ("customer_id", "missing"), ("age", "type"), ("gender", "category"), ("leaky_feature", "missing"), ("churn", "range"),
    ]


def test_unexpected_columns_only_warn(spark, contract):
    df = spark.createDataFrame([("a", 1, "M", 1.0, "l", 0.0, 9)], "customer_id string, age bigint, gender string, revenue double, leaky_feature string, churn double, more int")
    with pytest.warns(UserWarning, match="does not have"):
        V.enforce(df, contract)


def test_integers_lenient_and_strict(spark, contract, tmp_path):
    path = put(tmp_path, ["CUST_001,25.5,M,1.0,l,0.0", "CUST_002,26.0,M,1.0,l,0.0"])
    df, bad = readers.read(spark, path, contract, mode="report", integers="double")
    assert bad.filter("rule = 'type'").count() == 0
    assert sorted(r["age"] for r in df.collect()) == [25.5, 26.0]
    df, bad = readers.read(spark, path, contract, mode="report")
    assert bad.filter("rule = 'type' AND observed = 1").count() == 1
    assert {r["age"] for r in df.collect()} == {None, 26}


def test_quality_report(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), ("c", 3), ("d", 4)], "customer_id string, age int")
    rep = {(r["column"], r["metric"]): r["value"] for r in V.quality_report(df).collect()}
    assert rep[("*", "total_rows")] == 4 and rep[("*", "total_columns")] == 2
    assert rep[("age", "missing_fraction")] == 0.25
    assert V.quality_issues(df, 0.25).count() == 0  # strictly above
    assert V.quality_issues(df, 0.2).first()["issue"] == "age: 25.0% missing, more than 20.0%"


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), "NA"), (1.0, "x")], "a double, b string")
    assert [tuple(r) for r in readers.clean_missing(df, texts=True).collect()] == [(None, None), (1.0, "x")]
    # the tokens are a habit of CSV files: in typed sources the text NA is a text
    assert [tuple(r) for r in readers.clean_missing(df).collect()] == [(None, "NA"), (1.0, "x")]


def test_csv_rows_that_cannot_be_read(spark, contract, tmp_path):
    path = put(tmp_path, [GOOD[0], GOOD[1] + ",EXTRA,99"])
    with pytest.raises(ValueError, match="more fields"):
        readers.read(spark, path, contract)
    _, bad = readers.read(spark, path, contract, mode="report")
    assert [(r["rule"], r["observed"]) for r in bad.filter("phase = 0").collect()] == [("malformed", 1.0)]
    path = put(tmp_path, ['CUST_001,25,M,1.0,"two', 'lines",0.0'])
    with pytest.raises(ValueError, match="multi_line"):
        readers.read(spark, path, contract)


@pytest.mark.filterwarnings("ignore::UserWarning")
def test_quotes_and_line_breaks(spark, contract, tmp_path):
    path = put(tmp_path, ['CUST_001,25,M,1.0,"he said ""hi"", ok",0.0', 'CUST_002,26,F,2.0,"two\nlines",0.0', 'CUST_003,27,M,1.0,"say ""hi""",0.0'])
    df = readers.read(spark, path, contract, multi_line=True)
    assert sorted(r["leaky_feature"] for r in df.collect()) == ['he said "hi", ok', 'say "hi"', "two\nlines"]


def test_all_invalid_categories_are_listed(spark, contract, tmp_path):
    rows = [f"CUST_00{i},25,{g},1.0,l,0.0" for i, g in enumerate(("Zed", "M", "Abc", "Zed"))]
    _, bad = readers.read(spark, put(tmp_path, rows), contract, mode="report")
    assert bad.filter("rule = 'category'").first()["message"].endswith(": Abc, Zed")


def test_request_records(spark, tmp_path):
    path = tmp_path / "req.json"
    path.write_text('{\n "features": [\n {"customer_id": "T1", "age": 35},\n {"customer_id": "T2"}]}')
    rows = readers.read_requests(spark, str(path), "customer_id: string, age: bigint", multi_line=True).collect()
    assert [tuple(r) for r in rows] == [("T1", 35), ("T2", None)]


def test_decision_table_missing(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_decisions(spark, str(tmp_path / "none.csv"))
    assert readers.read_runs(spark, str(tmp_path / "none")) is None


def test_contract_is_saved_and_loaded(spark, tmp_path):
    from tabwright.plans.contracts import CHURN, STRICT
    from tabwright.sources.contract import Contract

    for c in (CHURN, STRICT):
        c.save(str(tmp_path / "contract"), spark)
        assert Contract.load(str(tmp_path / "contract"), spark) == c
