"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.operators import profile as D
from tabwright.plans.catalog import query
from tabwright.plans.contracts import CHURN
from tabwright.plans.frame import CHURN_SQL, NUMERIC, churn_sql, customer_churn, table
from tabwright.plans.queries_metrics import r6
from tabwright.plans.queries_quality import CORR_LINE, FRAME_COLUMNS, _line, _missing_rows

MISS = f"miss AS ({_missing_rows()})"


def long_sql(cols, src: str = "churn") -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c}::DOUBLE AS v FROM {src}" for c in cols)


@query(
    "missing_table",
    churn_sql('SELECT "column", m AS missing_count, round(100e0 * m / n, 6) AS missing_pct FROM miss WHERE m > 0', MISS),
)
def missing_table(spark, sf):
    return r6(D.missing_table(customer_churn(spark, sf)), "missing_pct")


@query(
    "dtype_histogram",
    churn_sql(
        """SELECT CASE WHEN "column" IN ('location', 'segment') THEN 'string' WHEN "column" IN ('acctbal', 'avg_total') THEN 'double'
          WHEN "column" = 'first_post_date' THEN 'timestamp_ntz' WHEN "column" = 'churn' THEN 'int' ELSE 'bigint' END AS dtype,
          count(*) AS columns, sum(n - m)::BIGINT AS cells FROM miss GROUP BY 1""",
        MISS,
    ),
)
def dtype_histogram(spark, sf):
    return D.dtype_histogram(customer_churn(spark, sf))


@query(
    "distinct_counts",
    churn_sql(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS \"distinct\" FROM churn" for c in FRAME_COLUMNS)),
)
def distinct_counts(spark, sf):
    return D.distinct_counts(customer_churn(spark, sf))


@query("distinct_counts_lineitem", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS \"distinct\" FROM lineitem"
    for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate")
))
def distinct_counts_lineitem(spark, sf):
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate"]
    return D.distinct_counts(table(spark, sf, "lineitem"), cols)


@query(
    "numeric_text_columns",
    """SELECT 'price' AS "column", count(*) AS "values" FROM orders UNION ALL SELECT 'rank', count(*) FILTER (WHERE o_orderstatus <> 'P') FROM orders""",
)
def numeric_text_columns(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_totalprice").cast("string").alias("price"),
        F.when(F.col("o_orderstatus") != "P", F.substring("o_orderpriority", 1, 1)).alias("rank"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderkey"),
    )
    return D.numeric_text(o)


@query(
    "target_stats",
    """SELECT round(avg(o_totalprice), 6) AS mean, round(median(o_totalprice), 6) AS median, round(stddev_samp(o_totalprice), 6) AS std,
    min(o_totalprice) AS min, max(o_totalprice) AS max FROM orders""",
)
def target_stats(spark, sf):
    return r6(D.target_stats(table(spark, sf, "orders"), "o_totalprice"), "mean", "median", "std")


@query(
    "class_balance",
    churn_sql(
        """SELECT count(churn) AS n, sum(churn)::BIGINT AS positives, (count(churn) - sum(churn))::BIGINT AS negatives, round(avg(churn), 6) AS rate,
        CASE WHEN avg(churn) BETWEEN 0.3e0 AND 0.7e0 THEN 'Balanced' ELSE 'Imbalanced' END AS balance FROM churn"""
    ),
)
def class_balance(spark, sf):
    return r6(D.class_balance(customer_churn(spark, sf), "churn"), "rate")


HIST_SQL = """SELECT "column", least(floor((v - lo) / ((hi - lo) / 30)), 29)::INT AS bin, round(lo + least(floor((v - lo) / ((hi - lo) / 30)), 29) * (hi - lo) / 30, 6) AS left_edge,
  count(*) AS n FROM (SELECT *, min(v) OVER (PARTITION BY "column") AS lo, max(v) OVER (PARTITION BY "column") AS hi FROM long WHERE v IS NOT NULL)
  GROUP BY 1, 2, 3"""


@query("histograms", churn_sql(HIST_SQL, f"long AS ({long_sql(NUMERIC)})"))
def histograms(spark, sf):
    return r6(D.histogram(customer_churn(spark, sf), NUMERIC, 30), "left_edge")


@query(
    "histogram_events",
    "WITH long AS (SELECT 'value' AS \"column\", value AS v FROM events) " + HIST_SQL.replace("30", "20").replace("29", "19"),
)
def histogram_events(spark, sf):
    return r6(D.histogram(table(spark, sf, "events"), ["value"], 20), "left_edge")


@query(
    "describe_numeric",
    churn_sql(
        """SELECT "column", count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS min, max(v) AS max,
        round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50, round(quantile_cont(v, 0.75), 6) AS q75
        FROM long GROUP BY "column" """,
        f"long AS ({long_sql(NUMERIC)})",
    ),
)
def describe_numeric(spark, sf):
    return r6(D.describe(customer_churn(spark, sf), NUMERIC), "mean", "std", "q25", "q50", "q75")


LINE_NUMS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "describe_lineitem",
    f"""WITH long AS ({long_sql(LINE_NUMS, "lineitem")})
    SELECT "column", count(v) AS count, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, min(v) AS min, max(v) AS max,
    round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50, round(quantile_cont(v, 0.75), 6) AS q75
    FROM long GROUP BY "column" """,
)
def describe_lineitem(spark, sf):
    d = D.describe(table(spark, sf, "lineitem"), LINE_NUMS)
    return r6(d, "q25", "q50", "q75").withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)})


OUTLIER_SQL = """q AS (SELECT "column", quantile_cont(v, 0.25) AS a, quantile_cont(v, 0.75) AS b FROM long GROUP BY "column")
  SELECT "column", round(a - 1.5e0 * (b - a), 6) AS low, round(b + 1.5e0 * (b - a), 6) AS high,
  count(*) FILTER (WHERE v < a - 1.5e0 * (b - a) OR v > b + 1.5e0 * (b - a)) AS outliers,
  round(count(*) FILTER (WHERE v < a - 1.5e0 * (b - a) OR v > b + 1.5e0 * (b - a)) / count(*)::DOUBLE, 6) AS share
  FROM long JOIN q USING ("column") GROUP BY "column", a, b"""


@query("iqr_outliers", "WITH " + CHURN_SQL + f", long AS ({long_sql(NUMERIC)}), " + OUTLIER_SQL)
def iqr_outliers(spark, sf):
    return r6(D.iqr_outliers(customer_churn(spark, sf), NUMERIC), "low", "high", "share")


@query("iqr_outliers_events", "WITH long AS (SELECT 'value' AS \"column\", value AS v FROM events), " + OUTLIER_SQL)
def iqr_outliers_events(spark, sf):
    return r6(D.iqr_outliers(table(spark, sf, "events"), ["value"]), "low", "high", "share")


@query("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def value_counts(spark, sf):
    return D.value_counts(table(spark, sf, "events"), "event_type")


@query(
    "target_correlations",
    churn_sql(" UNION ALL ".join(f"SELECT '{c}' AS feature, round(corr({c}, churn), 6) AS corr FROM churn" for c in NUMERIC)),
)
def target_correlations(spark, sf):
    return r6(D.target_correlations(customer_churn(spark, sf), NUMERIC, "churn"), "corr")


@query(
    "correlation_matrix",
    "WITH l AS (SELECT *, l_extendedprice * (1e0 - l_discount) AS net FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM l" for a in CORR_LINE for b in CORR_LINE
    ),
)
def correlation_matrix(spark, sf):
    return r6(D.correlation_matrix(_line(spark, sf), CORR_LINE), "corr")


@query(
    "churn_rate_by_category",
    churn_sql(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, {c} AS category, count(churn) AS total_count, sum(churn)::DOUBLE AS churn_count,
            round(avg(churn), 6) AS churn_rate FROM churn GROUP BY {c}"""
            for c in ("location", "segment")
        )
    ),
)
def churn_rate_by_category(spark, sf):
    return r6(D.rate_by_category(customer_churn(spark, sf), ["location", "segment"], "churn"), "churn_rate")


@query(
    "dataset_summary",
    churn_sql(
        """SELECT max(n) AS rows, count(*)::INT AS columns, 9 AS training_features, 2 AS leaky_features, sum(m)::BIGINT AS missing_cells,
        count(*) FILTER (WHERE m > 0) AS columns_with_missing, (SELECT round(avg(churn), 6) FROM churn) AS rate,
        (SELECT CASE WHEN avg(churn) BETWEEN 0.3e0 AND 0.7e0 THEN 'Balanced' ELSE 'Imbalanced' END FROM churn) AS balance,
        (SELECT count(*) FROM ("""
        + " UNION ALL ".join(f"SELECT count(DISTINCT {c}) AS d FROM churn" for c in FRAME_COLUMNS if c != "churn")
        + ") WHERE d > 50) AS high_cardinality FROM miss",
        MISS,
    ),
)
def dataset_summary(spark, sf):
    return r6(D.dataset_summary(customer_churn(spark, sf), CHURN), "rate")


MASKED = ["n_orders", "avg_total", "post_orders"]


@query(
    "missing_mask",
    churn_sql("SELECT customer_id, " + ", ".join(f"({c} IS NULL)::INT AS {c}" for c in MASKED) + " FROM churn"),
)
def missing_mask(spark, sf):
    return D.missing_mask(customer_churn(spark, sf), MASKED, ["customer_id"])


@query(
    "missing_by_bucket",
    churn_sql(
        "SELECT substr(md5('mask:' || customer_id::VARCHAR), 1, 1) AS bucket, "
        + ", ".join(f"round(avg(({c} IS NULL)::INT), 6) AS {c}" for c in MASKED)
        + " FROM churn GROUP BY 1"
    ),
)
def missing_by_bucket(spark, sf):
    return r6(D.missing_by_bucket(customer_churn(spark, sf), "customer_id", MASKED), *MASKED)
