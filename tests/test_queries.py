"""A cross-section of the registered queries against their SQL twins in DuckDB."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not found")

SAMPLE = [
    "churn_frame", "kfold_assignment", "stratified_holdout", "all_metrics_by_location", "roc_curve_by_segment", "pr_curve",
    "precision_recall_top_tenth", "contract_violations", "csv_type_violations", "feature_decisions", "model_comparison",
    "describe_numeric", "correlation_matrix", "fold_safe_numeric_stats", "onehot_unknown_batch_mode", "isotonic_calibrated",
    "residual_importance", "ks_lineitem_columns", "psi_order_price", "month_history", "synthetic_customers", "stream_daily_usage",
]


@pytest.fixture(scope="module")
def duck():
    import duckdb
    from check_oracle import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, duck, name):
    import __spark_entry__ as entry
    from check_oracle import rows

    df = entry.queries()[name](spark, SF)
    r = duck.execute(entry.oracle_sql()[name])
    assert rows(df.columns, [tuple(x) for x in df.collect()]) == rows([d[0] for d in r.description], r.fetchall())


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 25


def test_every_oracle_has_a_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["prediction_drift", "describe_numeric"])
def test_small_tables_equal_sql(spark, duck, name):
    import __spark_entry__ as entry
    from check_oracle import rows

    df = entry.queries()[name](spark, SF)
    r = duck.execute(entry.oracle_sql()[name])
    assert rows(df.columns, [tuple(x) for x in df.collect()]) == rows([d[0] for d in r.description], r.fetchall())
