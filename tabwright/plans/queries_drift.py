"""Drift and monitoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.operators import drift as G
from tabwright.operators import metrics as M
from tabwright.plans.catalog import query
from tabwright.plans.frame import churn_sql, scored, table
from tabwright.plans.queries_metrics import curve_sql, metrics_wide_sql, r6

SPLIT = "1998-06-01"
ORDERS_V = f"SELECT o_totalprice AS v, (o_orderdate < TIMESTAMP '{SPLIT}')::INT AS ref FROM orders"


def order_sides(spark, sf):
    o = table(spark, sf, "orders")
    before = F.col("o_orderdate") < F.lit(SPLIT).cast("timestamp_ntz")
    return o.filter(before), o.filter(~before)


def ks_sql(src: str, column: str) -> str:
    """``src`` yields (v, ref)."""
    return f"""src AS ({src}),
      cnt AS (SELECT v, sum(ref) AS a, sum(1 - ref) AS b FROM src WHERE v IS NOT NULL GROUP BY v),
      run AS (SELECT sum(a) OVER (ORDER BY v) AS ca, sum(b) OVER (ORDER BY v) AS cb, sum(a) OVER () AS na, sum(b) OVER () AS nb FROM cnt),
      st AS (SELECT '{column}' AS "column", max(abs(ca / na::DOUBLE - cb / nb::DOUBLE)) AS statistic, max(na)::BIGINT AS n_ref, max(nb)::BIGINT AS n_cur FROM run),
      ks AS (SELECT *, (SELECT least(1e0, greatest(0e0, 2e0 * sum((CASE WHEN j % 2 = 1 THEN 1e0 ELSE -1e0 END) * exp(-2e0 * j * j * (n_ref::DOUBLE * n_cur / (n_ref + n_cur)) * statistic * statistic)))) FROM range(1, 101) t(j)) AS tail FROM st),
      ksp AS (SELECT * EXCLUDE (tail), CASE WHEN sqrt(n_ref::DOUBLE * n_cur / (n_ref + n_cur)) * statistic < 0.2e0 THEN 1e0 ELSE tail END AS p_value FROM ks)"""


KS_OUT = """SELECT "column", round(statistic, 6) AS statistic, n_ref, n_cur, round(p_value, 6) AS p_value, p_value < 0.05e0 AS drift FROM ksp"""


@query("ks_order_price", "WITH " + ks_sql(ORDERS_V, "o_totalprice") + KS_OUT)
def ks_order_price(spark, sf):
    return r6(G.ks_two_sample(*order_sides(spark, sf), ["o_totalprice"]), "statistic", "p_value")


LINE_SPLIT = "1999-01-01"


@query(
    "ks_lineitem_columns",
    " UNION ALL ".join(
        "SELECT * FROM (WITH "
        + ks_sql(f"SELECT {c} AS v, (l_shipdate < TIMESTAMP '{LINE_SPLIT}')::INT AS ref FROM lineitem", c)
        + KS_OUT
        + ")"
        for c in ("l_quantity", "l_extendedprice", "l_discount")
    ),
)
def ks_lineitem_columns(spark, sf):
    l = table(spark, sf, "lineitem")
    before = F.col("l_shipdate") < F.lit(LINE_SPLIT).cast("timestamp_ntz")
    out = G.ks_two_sample(l.filter(before), l.filter(~before), ["l_quantity", "l_extendedprice", "l_discount"])
    return r6(out, "statistic", "p_value")


@query(
    "chi_square_order_categories",
    " UNION ALL ".join(
        f"""SELECT * FROM (WITH c AS (SELECT {c} AS v, count(*) FILTER (WHERE o_orderdate < TIMESTAMP '{SPLIT}') AS a,
          count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '{SPLIT}') AS b FROM orders WHERE {c} IS NOT NULL GROUP BY 1),
          t AS (SELECT sum(a) AS na, sum(b) FILTER (WHERE a > 0) AS nb FROM c)
          SELECT '{c}' AS "column", round(sum(power(b - a * nb / na::DOUBLE, 2) / (a * nb / na::DOUBLE)) FILTER (WHERE a > 0), 6) AS statistic,
          count(*) FILTER (WHERE a > 0) - 1 AS dof, coalesce(sum(b) FILTER (WHERE a = 0), 0)::BIGINT AS unseen FROM c, t)"""
        for c in ("o_orderpriority", "o_orderstatus")
    ),
)
def chi_square_order_categories(spark, sf):
    out = G.chi_square(*order_sides(spark, sf), ["o_orderpriority", "o_orderstatus"])
    return r6(out.select("column", "statistic", "dof", "unseen"), "statistic")


def psi_sql(src: str, column: str) -> str:
    """``src`` yields (v, ref); deciles of the reference side."""
    return f"""psrc AS ({src}),
      edges AS (SELECT DISTINCT quantile_cont(v, q / 10e0) AS e FROM psrc, range(1, 10) t(q) WHERE ref = 1 GROUP BY q),
      binned AS (SELECT ref, (SELECT count(*) FROM edges WHERE v > e) AS b FROM psrc WHERE v IS NOT NULL),
      shares AS (SELECT b, greatest(sum(ref) / (sum(sum(ref)) OVER ())::DOUBLE, 1e-4) AS r, greatest(sum(1 - ref) / (sum(sum(1 - ref)) OVER ())::DOUBLE, 1e-4) AS c FROM binned GROUP BY b),
      psi AS (SELECT '{column}' AS "column", sum((c - r) * ln(c / r)) AS psi FROM shares)"""


BAND = "CASE WHEN psi < 0.1e0 THEN 'none' WHEN psi < 0.2e0 THEN 'moderate' ELSE 'significant' END AS band"


@query(
    "psi_order_price",
    "WITH " + psi_sql(ORDERS_V.replace("quantile_cont", "quantile_cont"), "o_totalprice").replace("quantile_cont(v, q / 10e0)", "list_extract(quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]), q)")
    + f' SELECT "column", round(psi, 6) AS psi, {BAND} FROM psi',
)
def psi_order_price(spark, sf):
    return r6(G.psi(*order_sides(spark, sf), ["o_totalprice"]), "psi")


SCORE_V = "SELECT p AS v, (segment = 'BUILDING')::INT AS ref FROM scored"
DECILES = "list_extract(quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]), q)"


@query(
    "prediction_drift",
    churn_sql(
        f"""SELECT "column", round(statistic, 6) AS statistic, n_ref, n_cur, round(p_value, 6) AS p_value, p_value < 0.05e0 AS drift, round(psi, 6) AS psi, {BAND}
        FROM ksp JOIN psi USING ("column")""",
        ks_sql(SCORE_V, "p") + ", " + psi_sql(SCORE_V, "p").replace("quantile_cont(v, q / 10e0)", DECILES),
    ),
)
def prediction_drift(spark, sf):
    s = scored(spark, sf)
    ref = F.col("segment") == "BUILDING"
    return r6(G.prediction_drift(s.filter(ref), s.filter(~ref), "p"), "statistic", "p_value", "psi")


YEARLY = """ys AS (SELECT year(o_orderdate)::INT AS year, (o_orderstatus = 'F')::INT AS y, round(1e0 / (1e0 + exp(1e0 - o_totalprice / 200000e0)), 2) AS p FROM orders)"""


def yearly_metrics(spark, sf):
    o = table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"),
        (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        F.round(1.0 / (1.0 + F.exp(1.0 - F.col("o_totalprice") / 200000.0)), 2).alias("p"),
    )
    return M.all_metrics(o, "y", "p", ["year"])


YEARLY_SQL = ", ".join([YEARLY, curve_sql("ys", "year"), metrics_wide_sql("ys", "year")])


@query("performance_by_year", "WITH " + YEARLY_SQL + " SELECT year, metric, value FROM metrics")
def performance_by_year(spark, sf):
    return r6(yearly_metrics(spark, sf), "value")


@query(
    "performance_alerts",
    "WITH " + YEARLY_SQL
    + """ SELECT year, metric, value, CASE metric WHEN 'roc_auc' THEN 0.5e0 ELSE 0.2e0 END AS "limit" FROM metrics
    WHERE (metric = 'roc_auc' AND value < 0.5e0) OR (metric = 'brier' AND value > 0.2e0)""",
)
def performance_alerts(spark, sf):
    return G.alerts(r6(yearly_metrics(spark, sf), "value"), {"roc_auc": ("below", 0.5), "brier": ("above", 0.2)})


@query(
    "cusum_event_value",
    """WITH d AS (SELECT event_type, ts::DATE AS day, avg(value) AS x FROM events GROUP BY 1, 2),
    z AS (SELECT *, x - avg(x) OVER (PARTITION BY event_type) AS dev FROM d),
    r AS (SELECT *, sum(dev - 0.5e0) OVER (PARTITION BY event_type ORDER BY day) AS up, sum(-dev - 0.5e0) OVER (PARTITION BY event_type ORDER BY day) AS dn FROM z),
    s AS (SELECT *, up - least(0e0, min(up) OVER (PARTITION BY event_type ORDER BY day)) AS hi, dn - least(0e0, min(dn) OVER (PARTITION BY event_type ORDER BY day)) AS lo FROM r)
    SELECT event_type, day, round(x, 6) AS x, round(hi, 6) AS cusum_high, round(lo, 6) AS cusum_low, hi > 5e0 OR lo > 5e0 AS alarm FROM s""",
)
def cusum_event_value(spark, sf):
    e = table(spark, sf, "events")
    d = e.groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.avg("value").alias("x"))
    return r6(G.cusum(d, ["event_type"], "day", "x", 0.5, 5.0), "x", "cusum_high", "cusum_low")
