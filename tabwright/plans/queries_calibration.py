"""Calibration queries. The isotonic twin uses the max-min formula over distinct scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.functions.scalar import logit
from tabwright.operators import calibrate as C
from tabwright.operators import metrics as M
from tabwright.plans.catalog import query
from tabwright.plans.frame import churn_sql, scored
from tabwright.plans.queries_metrics import SQL_ECE_BIN, curve_sql, fold_sql, metrics_wide_sql, r6
from tabwright.session import settle

# iso(p, cal): weighted isotonic fit of churn on the distinct scores
ISO_SQL = """pts AS (SELECT p, count(*) AS n, sum(churn) AS s, row_number() OVER (ORDER BY p) AS i FROM scored GROUP BY p),
  cum AS (SELECT *, sum(n) OVER (ORDER BY i) AS cn, sum(s) OVER (ORDER BY i) AS cs FROM pts),
  avgs AS (SELECT a.i AS a, b.i AS b, (b.cs - a.cs + a.s)::DOUBLE / (b.cn - a.cn + a.n) AS m FROM cum a JOIN cum b ON a.i <= b.i),
  mins AS (SELECT c.i, v.a, min(v.m) AS m FROM cum c JOIN avgs v ON v.a <= c.i AND v.b >= c.i GROUP BY 1, 2),
  iso AS (SELECT cum.p, max(m) AS cal FROM mins JOIN cum USING (i) GROUP BY cum.p)"""


@query("isotonic_calibrated", churn_sql("SELECT customer_id, p, round(cal, 6) AS prob_cal FROM scored JOIN iso USING (p)", ISO_SQL))
def isotonic_calibrated(spark, sf):
    s = settle(scored(spark, sf).select("customer_id", "churn", "p"), "scores")
    return r6(C.IsotonicCalibrator().fit(s, "churn", "p").transform(s, "p").drop("churn"), "prob_cal")


BRIERS = """briers AS (SELECT 'uncalibrated' AS method, avg((p - churn) * (p - churn)) AS score FROM scored
  UNION ALL SELECT 'isotonic', avg((cal - churn) * (cal - churn)) FROM scored JOIN iso USING (p))"""


@query(
    "calibration_choice",
    churn_sql(
        """SELECT method, round(score, 6) AS score, method = (CASE WHEN (SELECT score FROM briers WHERE method = 'isotonic') <
          (SELECT score FROM briers WHERE method = 'uncalibrated') THEN 'isotonic' ELSE 'uncalibrated' END) AS chosen FROM briers""",
        ISO_SQL + ", " + BRIERS,
    ),
)
def calibration_choice(spark, sf):
    s = settle(scored(spark, sf).select("customer_id", "churn", "p"), "scores")
    c = C.select_best_calibrator(s, "churn", "p")
    rows = [(m, round(v, 6), m == c.method) for m, v in c.scores.items()]
    return spark.createDataFrame(rows, "method string, score double, chosen boolean")


@query(
    "metrics_after_calibration",
    churn_sql(
        "SELECT g, metric, value FROM metrics",
        ", ".join(
            [
                ISO_SQL,
                "ys AS (SELECT 'all' AS g, churn AS y, round(cal, 9) AS p FROM scored JOIN iso USING (p))",
                curve_sql("ys", "g"),
                metrics_wide_sql("ys", "g"),
            ]
        ),
    ),
)
def metrics_after_calibration(spark, sf):
    s = settle(scored(spark, sf).select("customer_id", "churn", "p"), "scores")
    cal = C.IsotonicCalibrator().fit(s, "churn", "p").transform(s, "p")
    cal = cal.select(F.lit("all").alias("g"), "churn", F.round("prob_cal", 9).alias("q"))
    return r6(M.all_metrics(cal, "churn", "q", ["g"]), "value")

def _platt_sql(points: str, name: str = "platt", steps: int = 25) -> str:
    """Step ``name(f, a, b)``: Newton's steps to the penalised fit over ``points(f, z, n, s)``, one row per step."""
    return f"""{name}_steps(f, k, a, b) AS (SELECT DISTINCT f, 0, 0e0, 0e0 FROM {points} UNION ALL
      SELECT f, k + 1, a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab), b - (haa * gb - hab * ga) / (haa * hbb - hab * hab) FROM (
        SELECT f, k, a, b, sum((n * q - s) * z) + a AS ga, sum(n * q - s) AS gb, sum(n * q * (1 - q) * z * z) + 1 AS haa,
               sum(n * q * (1 - q) * z) AS hab, sum(n * q * (1 - q)) AS hbb
        FROM (SELECT t.*, x.z, x.n, x.s, 1e0 / (1e0 + exp(-(t.a * x.z + t.b))) AS q FROM {name}_steps t JOIN {points} x ON x.f = t.f WHERE k < {steps})
        GROUP BY f, k, a, b)),
      {name} AS (SELECT f, a, b FROM {name}_steps WHERE k = {steps})"""


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


Z_SQL = "ln(p / (1e0 - p))"
PLATT_ALL = f"zs AS (SELECT 0 AS f, {Z_SQL} AS z, count(*) AS n, sum(churn) AS s FROM scored GROUP BY p)"


@query(
    "platt_calibrated",
    _recursive(
        churn_sql(
            f"SELECT customer_id, p, round(1e0 / (1e0 + exp(-(a * {Z_SQL} + b))), 6) AS prob_cal FROM scored, platt",
            f"{PLATT_ALL}, {_platt_sql('zs')}",
        )
    ),
)
def platt_calibrated(spark, sf):
    s = settle(scored(spark, sf).select("customer_id", "churn", "p", logit("p").alias("z")), "scores")
    return r6(C.PlattCalibrator().fit(s, "churn", "z").transform(s, "z").select("customer_id", "p", "prob_cal"), "prob_cal")


# fits f = 0, 1, 2 leave out that fold, f = 3 none; iso is read between its points
CROSS_SQL = f"""{fold_sql("scored", "customer_id", 3)},
  fit AS (SELECT f, p, {Z_SQL} AS z, count(*) AS n, sum(churn) AS s FROM folded, range(4) r(f) WHERE fold <> f GROUP BY f, p),
  {_platt_sql("fit")},
  cum AS (SELECT *, row_number() OVER w AS i, sum(n) OVER w AS cn, sum(s) OVER w AS cs FROM fit WINDOW w AS (PARTITION BY f ORDER BY p)),
  avgs AS (SELECT a.f, a.i AS a, b.i AS b, (b.cs - a.cs + a.s)::DOUBLE / (b.cn - a.cn + a.n) AS m FROM cum a JOIN cum b ON a.f = b.f AND a.i <= b.i),
  mins AS (SELECT c.f, c.i, v.a, min(v.m) AS m FROM cum c JOIN avgs v ON v.f = c.f AND v.a <= c.i AND v.b >= c.i GROUP BY 1, 2, 3),
  iso AS (SELECT cum.f, cum.p, max(m) AS cal FROM mins JOIN cum USING (f, i) GROUP BY cum.f, cum.p),
  want AS (SELECT DISTINCT r.f, p FROM scored, range(4) r(f)),
  near AS (SELECT w.f, w.p, max(i.p) FILTER (i.p <= w.p) AS lo, min(i.p) FILTER (i.p >= w.p) AS hi FROM want w JOIN iso i ON i.f = w.f GROUP BY 1, 2),
  step AS (SELECT near.f, near.p, CASE WHEN lo IS NULL THEN h.cal WHEN hi IS NULL OR lo = hi THEN l.cal
    ELSE l.cal + (h.cal - l.cal) * (near.p - lo) / (hi - lo) END AS cal
    FROM near LEFT JOIN iso l ON l.f = near.f AND l.p = lo LEFT JOIN iso h ON h.f = near.f AND h.p = hi),
  every AS (SELECT customer_id, churn AS y, f, fold, x.p AS plain, cal AS isotonic, 1e0 / (1e0 + exp(-(a * ln(x.p / (1e0 - x.p)) + b))) AS platt
    FROM folded x JOIN step ON step.p = x.p JOIN platt USING (f)),
  ys AS (SELECT 'uncalibrated' AS g, y, plain AS p FROM every WHERE f = fold UNION ALL SELECT 'isotonic', y, isotonic FROM every WHERE f = fold
    UNION ALL SELECT 'platt', y, platt FROM every WHERE f = fold),
  bins AS (SELECT g, {SQL_ECE_BIN} AS b, count(*) AS n, sum(y) AS sy, sum(p) AS sp FROM ys GROUP BY g, b),
  ece AS (SELECT g, sum(CASE WHEN b >= 1 THEN abs(sy - sp) ELSE 0e0 END) / sum(n) AS e FROM bins GROUP BY g),
  three AS (SELECT max(e) FILTER (g = 'uncalibrated') AS u, max(e) FILTER (g = 'isotonic') AS i, max(e) FILTER (g = 'platt') AS t FROM ece),
  pick AS (SELECT CASE WHEN t < i AND t < u THEN 'platt' WHEN i < u THEN 'isotonic' ELSE 'uncalibrated' END AS method FROM three)"""


@query(
    "calibration_choice_cross_fit",
    _recursive(
        churn_sql(
            """SELECT customer_id, method, plain AS p, round(CASE method WHEN 'platt' THEN platt WHEN 'isotonic' THEN isotonic ELSE plain END, 6) AS prob_cal
            FROM every, pick WHERE f = 3""",
            CROSS_SQL,
        )
    ),
)
def calibration_choice_cross_fit(spark, sf):
    s = settle(scored(spark, sf).select("customer_id", "churn", "p", logit("p").alias("z")), "scores")
    c = C.select_best_calibrator(s, "churn", "p", "z", metric="ece", cross_fit=True, key="customer_id", k=3)
    return r6(c.transform(s).select("customer_id", F.lit(c.method).alias("method"), "p", "prob_cal"), "prob_cal")


@query(
    "fitted_calibrators",
    _recursive(
        churn_sql(
            f"""SELECT p, n, round(1e0 / (1e0 + exp(-(a * {Z_SQL} + b))), 6) AS platt, round(cal, 6) AS isotonic FROM iso JOIN pts USING (p), platt""",
            f"{ISO_SQL}, {PLATT_ALL}, {_platt_sql('zs')}",
        )
    ),
)
def fitted_calibrators(spark, sf):
    """Both kinds of calibrator by their name, over the distinct scores."""
    s = settle(scored(spark, sf).select("churn", "p", logit("p").alias("z")), "scores")
    by_score = s.groupBy("p", "z").agg(F.count(F.lit(1)).alias("n"))
    for method, column in (("platt", "z"), ("isotonic", "p")):
        by_score = C.fit_calibrator(s, "churn", "p", "z", method).transform(by_score, column, method)
    return r6(by_score.select("p", "n", "platt", "isotonic"), "platt", "isotonic")


@query(
    "calibrator_reload",
    churn_sql("SELECT p, round(cal, 6) AS prob_cal, count(*) AS n FROM scored JOIN iso USING (p) GROUP BY p, cal", ISO_SQL),
)
def calibrator_reload(spark, sf):
    from tabwright.session import scratch

    s = scored(spark, sf).select("churn", "p")
    path = scratch(spark, "isotonic")
    C.IsotonicCalibrator("raise").fit(s, "churn", "p").write(path)
    back = C.IsotonicCalibrator.load(path).transform(s, "p")
    return back.groupBy("p", F.round("prob_cal", 6).alias("prob_cal")).agg(F.count(F.lit(1)).alias("n"))
