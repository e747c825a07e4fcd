"""Feature engineering and synthetic-data queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.operators import features as L
from tabwright.operators import validate as V
from tabwright.plans.catalog import query
from tabwright.plans.contracts import CHURN
from tabwright.plans.frame import churn_sql, customer_churn, table
from tabwright.plans.queries_metrics import r6
from tabwright.sources import synth


@query(
    "interaction_products",
    churn_sql(
        """SELECT customer_id, round(n_orders * avg_total, 4) AS n_orders_x_avg_total, round(n_urgent * acctbal, 4) AS n_urgent_x_acctbal,
        round((tenure_days * n_orders)::DOUBLE, 4) AS tenure_days_x_n_orders FROM churn"""
    ),
)
def interaction_products(spark, sf):
    products = CHURN.feature_engineering["interaction_features"]
    out = L.interactions(customer_churn(spark, sf), products)
    made = ["n_orders_x_avg_total", "n_urgent_x_acctbal", "tenure_days_x_n_orders"]
    return out.select("customer_id", *[F.round(c, 4).alias(c) for c in made])


EVENT_ASOF = "2024-01-25"


@query(
    "days_since_events",
    f"""SELECT user_id, date_diff('day', max(ts), TIMESTAMP '{EVENT_ASOF}') AS days_since_any,
    date_diff('day', max(ts) FILTER (WHERE event_type = 'purchase'), TIMESTAMP '{EVENT_ASOF}') AS days_since_purchase
    FROM events WHERE ts <= TIMESTAMP '{EVENT_ASOF}' GROUP BY user_id""",
)
def days_since_events(spark, sf):
    e = table(spark, sf, "events")
    return L.days_since(e, "user_id", "ts", EVENT_ASOF, {"days_since_any": F.lit(True), "days_since_purchase": F.col("event_type") == "purchase"})


@query(
    "usage_counts",
    f"""SELECT user_id, count(*) FILTER (WHERE event_type = 'click' AND ts > TIMESTAMP '{EVENT_ASOF}' - INTERVAL 7 DAYS) AS clicks_7d,
    count(*) FILTER (WHERE event_type = 'view' AND ts > TIMESTAMP '{EVENT_ASOF}' - INTERVAL 14 DAYS) AS views_14d,
    count(*) FILTER (WHERE event_type = 'error' AND ts > TIMESTAMP '{EVENT_ASOF}' - INTERVAL 20 DAYS) AS errors_20d
    FROM events WHERE ts > TIMESTAMP '{EVENT_ASOF}' - INTERVAL 20 DAYS AND ts <= TIMESTAMP '{EVENT_ASOF}' GROUP BY user_id""",
)
def usage_counts(spark, sf):
    kind = F.col("event_type")
    counts = {"clicks_7d": (7, kind == "click"), "views_14d": (14, kind == "view"), "errors_20d": (20, kind == "error")}
    return L.usage_counts(table(spark, sf, "events"), "user_id", "ts", EVENT_ASOF, counts)


@query(
    "month_history",
    """WITH m AS (SELECT o_custkey, (year(o_orderdate) * 12 + month(o_orderdate) - 1)::BIGINT AS month, round(sum(o_totalprice), 6) AS revenue,
      count(*) AS orders FROM orders GROUP BY 1, 2)
    SELECT o_custkey, month, revenue, orders,
      round(avg(revenue) OVER (PARTITION BY o_custkey ORDER BY month RANGE BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS avg_revenue_3m,
      max(orders) OVER (PARTITION BY o_custkey ORDER BY month RANGE BETWEEN 5 PRECEDING AND CURRENT ROW) AS max_orders_6m,
      round(covar_pop(revenue, month::DOUBLE) OVER w / nullif(var_pop(month::DOUBLE) OVER w, 0e0), 3) AS trend_revenue_3m
    FROM m WINDOW w AS (PARTITION BY o_custkey ORDER BY month RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def month_history(spark, sf):
    m = L.monthly(
        table(spark, sf, "orders"), "o_custkey", "o_orderdate",
        {"revenue": F.round(F.sum("o_totalprice"), 6), "orders": F.count(F.lit(1))},
    )
    h = L.month_history(m, "o_custkey", [("revenue", 3)], [("orders", 6)], [("revenue", 3)])
    return r6(h, "avg_revenue_3m").withColumn("trend_revenue_3m", F.round("trend_revenue_3m", 3))


@query(
    "ratio_features",
    churn_sql(
        """SELECT customer_id, round(n_urgent / nullif(n_orders, 0)::DOUBLE, 6) AS urgent_share,
        round(tenure_days / nullif(n_urgent, 0)::DOUBLE, 6) AS days_per_urgent FROM churn"""
    ),
)
def ratio_features(spark, sf):
    return customer_churn(spark, sf).select(
        "customer_id",
        F.round(L.ratio("n_urgent", "n_orders"), 6).alias("urgent_share"),
        F.round(L.ratio("tenure_days", "n_urgent"), 6).alias("days_per_urgent"),
    )


@query(
    "percentile_rank",
    churn_sql(
        """SELECT customer_id, n_orders, round((less + (same + 1) / 2e0) / n, 6) AS percentile FROM churn LEFT JOIN (
        SELECT n_orders, count(*) AS same, sum(count(*)) OVER (ORDER BY n_orders) - count(*) AS less, sum(count(*)) OVER () AS n
        FROM churn WHERE n_orders IS NOT NULL GROUP BY n_orders) USING (n_orders)"""
    ),
)
def percentile_rank(spark, sf):
    c = customer_churn(spark, sf).select("customer_id", "n_orders")
    return r6(L.percentile_rank(c, "n_orders", "customer_id"), "percentile")


@query(
    "percentile_rank_lineitem",
    """SELECT l_quantity, round((less + (same + 1) / 2e0) / n, 6) AS percentile, same AS rows FROM (
    SELECT l_quantity, count(*) AS same, sum(count(*)) OVER (ORDER BY l_quantity) - count(*) AS less, sum(count(*)) OVER () AS n FROM lineitem GROUP BY l_quantity)""",
)
def percentile_rank_lineitem(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity")
    r = L.percentile_rank(l, "l_quantity", "l_orderkey")
    return r.groupBy("l_quantity", F.round("percentile", 6).alias("percentile")).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "z_scores",
    churn_sql(
        "SELECT customer_id, "
        + ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}_zscore" for c in ("acctbal", "n_orders"))
        + " FROM churn"
    ),
)
def z_scores(spark, sf):
    z = ["acctbal_zscore", "n_orders_zscore"]
    return r6(L.z_scores(customer_churn(spark, sf), ["acctbal", "n_orders"]).select("customer_id", *z), *z)


@query(
    "binned_groups",
    churn_sql("SELECT customer_id, CASE WHEN n_orders < 5 THEN 'few' WHEN n_orders < 10 THEN 'some' WHEN n_orders IS NOT NULL THEN 'many' END AS band FROM churn"),
)
def binned_groups(spark, sf):
    return customer_churn(spark, sf).select("customer_id", L.bin_label("n_orders", [5, 10], ["few", "some", "many"]).alias("band"))


@query(
    "polynomial_features",
    churn_sql(
        """SELECT customer_id, slot::INT AS slot, round(CASE slot WHEN 0 THEN x WHEN 1 THEN x * x WHEN 2 THEN z WHEN 3 THEN x * z ELSE z * z END, 6) AS value
        FROM (SELECT customer_id, acctbal / 1000e0 AS x, coalesce(n_orders, 0)::DOUBLE AS z FROM churn), range(5) r(slot)"""
    ),
)
def polynomial_features(spark, sf):
    from pyspark.ml.functions import vector_to_array

    c = customer_churn(spark, sf).select("customer_id", (F.col("acctbal") / 1000.0).alias("x"), F.coalesce("n_orders", F.lit(0)).cast("double").alias("z"))
    v = L.polynomial(c, ["x", "z"]).select("customer_id", F.posexplode(vector_to_array("poly")).alias("slot", "value"))
    return r6(v, "value")


@query(
    "select_uncorrelated",
    """WITH l AS (SELECT *, l_extendedprice * (1e0 - l_discount) AS net FROM lineitem), r AS (SELECT corr(l_quantity, l_extendedprice) AS qx,
      corr(l_quantity, net) AS qn, corr(l_extendedprice, net) AS xn, count(*) AS n FROM l)
    SELECT 'l_quantity' AS feature FROM r UNION ALL SELECT 'l_extendedprice' FROM r WHERE abs(qx) <= 0.95e0
    UNION ALL SELECT 'net' FROM r WHERE abs(qn) <= 0.95e0 AND NOT (abs(qx) <= 0.95e0 AND abs(xn) > 0.95e0)""",
)
def select_uncorrelated(spark, sf):
    net = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    l = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", net.alias("net"))
    kept = V.drop_correlated(l, ["l_quantity", "l_extendedprice", "net"], 0.95)
    return spark.createDataFrame([(c,) for c in kept], "feature string")


# --------------------------------------------------------------- synthetic data


def u_sql(draw: str) -> str:
    return f"(('0x' || substr(md5('42:{draw}:' || id), 1, 13))::BIGINT / 4503599627370496e0)"


def poisson_sql(name: str, rate: str, draw: str, top: int) -> str:
    """Step ``name(id, n)``: how many k below ``top`` have P(N <= k) <= u."""
    return f"""{name} AS (SELECT id, count(*) FILTER (WHERE cdf <= u) AS n FROM (
      SELECT id, {u_sql(draw)} AS u, sum(exp(-({rate}) + k * ln({rate}) - lgamma(k + 1))) OVER (PARTITION BY id ORDER BY k) AS cdf
      FROM u1, range({top}) r(k)) GROUP BY id)"""


def normal_sql(mean: str, sd: str, draw: str) -> str:
    return f"({mean} + {sd} * sqrt(-2e0 * ln(1e0 - {u_sql(draw + '1')})) * cos(6.283185307179586e0 * {u_sql(draw + '2')}))"


SYNTH_SQL = ", ".join(
    [
        "ids AS (SELECT (c_custkey + 1)::BIGINT AS id FROM customer)",
        f"""u1 AS (SELECT id, least(greatest(trunc(-180e0 * ln(1e0 - {u_sql('duration')}))::BIGINT, 1), 1095) AS duration,
          least(greatest(least(greatest(trunc(-180e0 * ln(1e0 - {u_sql('duration')}))::BIGINT, 1), 1095) / 180e0, 0.5e0), 2e0) AS mult,
          CASE WHEN {u_sql('plan')} < 0.6e0 THEN 'Basic' WHEN {u_sql('plan')} < 0.9e0 THEN 'Premium' ELSE 'Enterprise' END AS plan FROM ids)""",
        poisson_sql("logins", "15e0 * mult", "logins", synth.poisson_top(30.0)),
        poisson_sql("views", "50e0 * mult", "pages", synth.poisson_top(100.0)),
        poisson_sql("tickets", "0.5e0", "tickets", synth.poisson_top(0.5)),
        poisson_sql("failures", "0.2e0", "failures", synth.poisson_top(0.2)),
    ]
)


@query(
    "synthetic_customers",
    "WITH " + SYNTH_SQL
    + f""" SELECT printf('CUST_%06d', id) AS customer_id,
      CASE WHEN {u_sql('missing-age')} >= 0.02e0 THEN least(greatest(trunc({normal_sql('35e0', '12e0', 'age')})::BIGINT, 18), 80) END AS age,
      CASE WHEN {u_sql('missing-gender')} >= 0.01e0 THEN CASE WHEN {u_sql('gender')} < 0.45e0 THEN 'M' WHEN {u_sql('gender')} < 0.9e0 THEN 'F' ELSE 'Other' END END AS gender,
      plan AS subscription_type, duration AS subscription_duration_days,
      round(greatest({normal_sql("CASE plan WHEN 'Basic' THEN 29e0 WHEN 'Premium' THEN 79e0 ELSE 199e0 END", "CASE plan WHEN 'Basic' THEN 5e0 WHEN 'Premium' THEN 10e0 ELSE 25e0 END", 'revenue')}, 0e0), 6) AS monthly_revenue,
      logins.n AS login_frequency, views.n AS page_views_total, tickets.n AS support_tickets_count, failures.n AS payment_failures_count,
      ({u_sql('churn')} < least(greatest(0.15e0 + CASE WHEN tickets.n > 2 THEN 0.3e0 ELSE 0e0 END + CASE WHEN failures.n > 1 THEN 0.4e0 ELSE 0e0 END
        + CASE WHEN logins.n < 5 THEN 0.25e0 ELSE 0e0 END + CASE WHEN duration < 30 THEN 0.2e0 ELSE 0e0 END, 0e0), 1e0))::INT::DOUBLE AS churn_probability
    FROM u1 JOIN logins USING (id) JOIN views USING (id) JOIN tickets USING (id) JOIN failures USING (id)""",
)
def synthetic_customers(spark, sf):
    ids = table(spark, sf, "customer").select((F.col("c_custkey") + 1).alias("id"))
    out = synth.customers_for(ids, "id", 42)
    return out.select(
        "customer_id", "age", "gender", "subscription_type", "subscription_duration_days", F.round("monthly_revenue", 6).alias("monthly_revenue"),
        "login_frequency", "page_views_total", "support_tickets_count", "payment_failures_count", "churn_probability",
    )


