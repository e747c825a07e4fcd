"""Importance queries; the SQL twins build the same ring by row numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.operators import importance as I
from tabwright.operators import split as S
from tabwright.plans.catalog import query
from tabwright.plans.frame import churn_sql, folded, scored, table
from tabwright.plans.queries_metrics import r6

FEATS = ["acctbal", "n_orders", "n_urgent"]
FILLED = """base AS (SELECT customer_id, acctbal, coalesce(n_orders, 0) AS n_orders, coalesce(n_urgent, 0) AS n_urgent, churn, p, churn - p AS r,
    row_number() OVER (ORDER BY md5('42:' || customer_id::VARCHAR)) - 1 AS i, count(*) OVER () AS n FROM scored)"""


def filled(spark, sf):
    return scored(spark, sf).fillna(0, ["n_orders", "n_urgent"])


@query(
    "ring_permutation",
    churn_sql(
        """SELECT a.customer_id, b.customer_id AS partner_1, c.customer_id AS partner_2, d.customer_id AS partner_3 FROM base a
        JOIN base b ON b.i = (a.i + 1) % a.n JOIN base c ON c.i = (a.i + 2) % a.n JOIN base d ON d.i = (a.i + 3) % a.n""",
        FILLED,
    ),
)
def ring_permutation(spark, sf):
    ring = I.on_ring(scored(spark, sf).select("customer_id"), "customer_id", 42, F.col("customer_id"), 3)
    return ring.select("customer_id", *[F.col(f"_shift{k}").alias(f"partner_{k}") for k in (1, 2, 3)])


def _residual_sql(r: int) -> str:
    per = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, k, abs(corr(a.{c}, a.r)) - abs(corr(a.{c}, b.r)) AS d FROM base a, range(1, {r + 1}) t(k), base b "
        f"WHERE b.i = (a.i + k) % a.n GROUP BY k"
        for c in FEATS
    )
    return churn_sql(
        "SELECT feature, round(avg(d), 6) AS importance_mean, round(stddev_pop(d), 6) AS importance_std FROM per GROUP BY feature",
        FILLED + f", per AS ({per})",
    )


@query("residual_importance", _residual_sql(10))
def residual_importance(spark, sf):
    out = I.residual_importance(filled(spark, sf), FEATS, "churn", "p", "customer_id", 10, 42)
    return r6(out.drop("importance_values"), "importance_mean", "importance_std")


@query("oof_importance", _residual_sql(10))
def oof_importance(spark, sf):
    f = filled(spark, sf)
    oof = folded(spark, sf, f, 3).select("customer_id", F.col("churn").alias("y_true"), F.col("p").alias("prob"))
    out = I.oof_importance(oof, f, FEATS, "customer_id", repeats=10, seed=42)
    return r6(out.drop("importance_values"), "importance_mean", "importance_std")


@query(
    "residual_importance_lineitem",
    """WITH base AS (SELECT l_quantity AS q, l_extendedprice AS x, l_discount AS d, (l_returnflag = 'R')::INT - l_tax AS r,
        row_number() OVER (ORDER BY md5('7:' || (l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber)),
          l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber) - 1 AS i, count(*) OVER () AS n FROM lineitem),
      per AS (SELECT k, abs(corr(a.q, a.r)) - abs(corr(a.q, b.r)) AS q, abs(corr(a.x, a.r)) - abs(corr(a.x, b.r)) AS x, abs(corr(a.d, a.r)) - abs(corr(a.d, b.r)) AS d
        FROM base a, range(1, 11) t(k), base b WHERE b.i = (a.i + k) % a.n GROUP BY k)
      SELECT 'q' AS feature, round(avg(q), 6) AS importance_mean, round(stddev_pop(q), 6) AS importance_std FROM per
      UNION ALL SELECT 'x', round(avg(x), 6), round(stddev_pop(x), 6) FROM per UNION ALL SELECT 'd', round(avg(d), 6), round(stddev_pop(d), 6) FROM per""",
)
def residual_importance_lineitem(spark, sf):
    l = table(spark, sf, "lineitem")
    key = F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    src = l.select(
        key.alias("key"), F.col("l_quantity").alias("q"), F.col("l_extendedprice").alias("x"), F.col("l_discount").alias("d"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"), F.col("l_tax").alias("p"),
    )
    out = I.residual_importance(src, ["q", "x", "d"], "y", "p", "key", 10, 7)
    return r6(out.drop("importance_values"), "importance_mean", "importance_std")


def closed_form(df):
    z = F.lit(-1.5) + 0.3 * F.col("n_urgent") + F.col("acctbal") / 10000.0 - 0.05 * F.col("n_orders")
    return df.withColumn("prob", F.round(1.0 / (1.0 + F.exp(-z)), 2))


P_OF = "round(1e0 / (1e0 + exp(-(-1.5e0 + 0.3e0 * {u} + {b} / 10000e0 - 0.05e0 * {o}))), 2)"


def _variants(r: int) -> str:
    def one(f):
        pick = {"acctbal": "a.acctbal", "n_orders": "a.n_orders", "n_urgent": "a.n_urgent"}
        pick[f] = "b." + f
        p = P_OF.format(u=pick["n_urgent"], b=pick["acctbal"], o=pick["n_orders"])
        return f"SELECT '{f}' AS feature, k, a.churn AS y, {p} AS p FROM base a, range(1, {r + 1}) t(k), base b WHERE b.i = (a.i + k) % a.n"

    return "vs AS (" + " UNION ALL ".join([*map(one, FEATS), f"SELECT 'base', 0, churn, {P_OF.format(u='n_urgent', b='acctbal', o='n_orders')} FROM base"]) + ")"


def _model_sql(r: int, value: str, steps: str) -> str:
    return churn_sql(
        f"""SELECT feature, round(avg(b.v - m.v), 6) AS importance_mean, round(stddev_pop(b.v - m.v), 6) AS importance_std FROM m,
        (SELECT v FROM m WHERE feature = 'base') b WHERE feature <> 'base' GROUP BY feature""",
        ", ".join([FILLED, _variants(r), *([steps] if steps else []), f"m AS (SELECT feature, k, {value} GROUP BY feature, k)"]),
    )


CURVE = """counts AS (SELECT feature, k, p, (count(*) FILTER (WHERE y = 1))::BIGINT AS tp, (count(*) FILTER (WHERE y = 0))::BIGINT AS fp FROM vs GROUP BY 1, 2, 3),
  curve AS (SELECT *, sum(tp) OVER (PARTITION BY feature, k ORDER BY p DESC) AS ctp, sum(tp) OVER (PARTITION BY feature, k) AS np,
            sum(fp) OVER (PARTITION BY feature, k) AS nn FROM counts)"""


def _model(spark, sf, metric, r):
    out = I.model_importance(filled(spark, sf), FEATS, closed_form, "churn", "customer_id", metric, r, 42)
    return r6(out.drop("importance_values"), "importance_mean", "importance_std")


@query("model_importance_auc", _model_sql(10, "sum(fp * (ctp - tp / 2e0)) / (max(np)::DOUBLE * max(nn)) AS v FROM curve", CURVE))
def model_importance_auc(spark, sf):
    return _model(spark, sf, "roc_auc", 10)


@query("model_importance_accuracy", _model_sql(10, "avg(((p > 0.5e0)::INT = y)::INT) AS v FROM vs", ""))
def model_importance_accuracy(spark, sf):
    return _model(spark, sf, "accuracy", 10)


@query("model_importance_custom_metric", _model_sql(10, "-avg((p - y) * (p - y)) AS v FROM vs", ""))
def model_importance_custom_metric(spark, sf):
    return _model(spark, sf, lambda y, p: -F.avg((p - y) * (p - y)), 10)


WEIGHTS = {"acctbal": 1e-4, "n_orders": -0.05, "n_urgent": 0.3}


@query(
    "linear_contributions_top",
    churn_sql(
        "SELECT feature, round(v, 6) AS mean_abs_contribution FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, avg(abs({w!r}::DOUBLE * ({c} - (SELECT avg({c}) FROM base)))) AS v FROM base" for c, w in WEIGHTS.items()
        )
        + ") ORDER BY v DESC LIMIT 2",
        FILLED,
    ),
)
def linear_contributions_top(spark, sf):
    return r6(I.linear_contributions(filled(spark, sf), WEIGHTS, 2), "mean_abs_contribution")
