"""Queries over splits, metrics and curves."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabwright.operators import metrics as M
from tabwright.operators import split as S
from tabwright.plans.catalog import query
from tabwright.plans.frame import churn_sql, customer_churn, folded, scored

EDGES = M.bin_edges(10)


def r6(df, *cols):
    """Round doubles to six digits so that two engines print the same value."""
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


def sql_edge_bin(p: str, edges, op: str) -> str:
    return "(" + " + ".join(f"({p} {op} {e!r}::DOUBLE)::INT" for e in edges) + ")"


SQL_ECE_BIN = sql_edge_bin("p", EDGES[1:], ">=")
SQL_CURVE_BIN = sql_edge_bin("p", EDGES[1:-1], "<").replace("p < ", "p > ")


def fold_sql(src: str, key: str, k: int, seed: int = 42, name: str = "folded") -> str:
    return f"""{name} AS (SELECT *, ((row_number() OVER (ORDER BY md5('{seed}:' || {key}::VARCHAR)) - 1) * {k}
      // count(*) OVER ())::INT AS fold FROM {src})"""


# tp/fp per score, running sums from the top; g is the group column list
def curve_sql(src: str, g: str = "") -> str:
    gp = f"{g}, " if g else ""
    part = f"PARTITION BY {g}" if g else ""
    return f"""counts AS (SELECT {gp}p, (count(*) FILTER (WHERE y = 1))::BIGINT AS tp,
        (count(*) FILTER (WHERE y = 0))::BIGINT AS fp FROM {src} GROUP BY {gp}p),
      curve AS (SELECT *, sum(tp) OVER ({part} ORDER BY p DESC) AS ctp, sum(fp) OVER ({part} ORDER BY p DESC) AS cfp,
        sum(tp) OVER ({part}) AS np, sum(fp) OVER ({part}) AS nn FROM counts)"""


SQL_AUC = "CASE WHEN max(np) > 0 AND max(nn) > 0 THEN sum(fp * (ctp - tp / 2e0)) / (max(np)::DOUBLE * max(nn)) ELSE 0e0 END"
SQL_AP = "CASE WHEN max(np) > 0 THEN sum(tp / np::DOUBLE * ctp / (ctp + cfp)) ELSE 0e0 END"
Y_SCORED = "ys AS (SELECT *, churn AS y FROM scored)"


@query("kfold_assignment", churn_sql("SELECT customer_id, fold FROM folded", fold_sql("scored", "customer_id", 5)))
def kfold_assignment(spark, sf):
    return folded(spark, sf, scored(spark, sf), 5).select("customer_id", "fold")


@query(
    "kfold_orders_sizes",
    "WITH " + fold_sql("orders", "o_orderkey", 7, 7)
    + " SELECT fold, count(*) AS n, round(avg(o_totalprice), 6) AS avg_price FROM folded GROUP BY fold",
)
def kfold_orders_sizes(spark, sf):
    from tabwright.plans.frame import table

    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    f = S.assign_folds(df, "o_orderkey", 7, 7)
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("o_totalprice"), 6).alias("avg_price"))


@query(
    "fold_train_val_counts",
    churn_sql(
        """SELECT i::INT AS fold, count(*) FILTER (WHERE fold <> i) AS n_train, count(*) FILTER (WHERE fold = i) AS n_val,
        (sum(churn) FILTER (WHERE fold = i))::BIGINT AS pos_val FROM folded, range(5) r(i) GROUP BY i""",
        fold_sql("scored", "customer_id", 5),
    ),
)
def fold_train_val_counts(spark, sf):
    f = folded(spark, sf, scored(spark, sf), 5)
    sizes = f.groupBy("fold").agg(F.count(F.lit(1)).alias("n_val"), F.sum("churn").alias("pos_val"))
    total = F.sum("n_val").over(Window.partitionBy())
    return sizes.select("fold", (total - F.col("n_val")).alias("n_train"), "n_val", "pos_val")


@query(
    "oof_coverage",
    churn_sql(
        "SELECT customer_id, fold, churn AS y_true, p AS prob FROM folded", fold_sql("scored", "customer_id", 3)
    ),
)
def oof_coverage(spark, sf):
    f = folded(spark, sf, scored(spark, sf), 3)
    parts = [
        S.val_part(f, i).select("customer_id", "fold", F.col("churn").alias("y_true"), F.col("p").alias("prob"))
        for i in range(3)
    ]
    return S.assemble_oof(parts, "customer_id")


@query(
    "stratified_holdout",
    churn_sql(
        """SELECT customer_id, churn, rn <= quota AS is_test FROM (
          SELECT s.customer_id, s.churn, row_number() OVER (PARTITION BY s.churn ORDER BY md5('42:' || customer_id::VARCHAR)) AS rn,
                 base + (CASE WHEN turn <= want - sumbase THEN 1 ELSE 0 END) AS quota
          FROM scored s JOIN (
            SELECT *, sum(base) OVER () AS sumbase, row_number() OVER (ORDER BY share - base DESC, churn) AS turn FROM (
              SELECT churn, ceil(0.2e0 * sum(n) OVER ()) AS want, ceil(0.2e0 * sum(n) OVER ()) * n / sum(n) OVER () AS share,
                     floor(ceil(0.2e0 * sum(n) OVER ()) * n / sum(n) OVER ()) AS base
              FROM (SELECT churn, count(*) AS n FROM scored GROUP BY churn))) q ON q.churn = s.churn)"""
    ),
)
def stratified_holdout(spark, sf):
    f = S.stratified_holdout(scored(spark, sf), "customer_id", "churn")
    return f.select("customer_id", "churn", "is_test")


@query(
    "roc_auc",
    churn_sql(f"SELECT round({SQL_AUC}, 6) AS roc_auc FROM curve", Y_SCORED + ", " + curve_sql("ys")),
)
def roc_auc(spark, sf):
    return r6(M.roc_auc(scored(spark, sf), "churn", "p"), "roc_auc")


@query(
    "average_precision",
    churn_sql(f"SELECT round({SQL_AP}, 6) AS pr_auc FROM curve", Y_SCORED + ", " + curve_sql("ys")),
)
def average_precision(spark, sf):
    return r6(M.average_precision(scored(spark, sf), "churn", "p"), "pr_auc")


@query("brier_by_segment", churn_sql("SELECT segment, round(avg((p - churn) * (p - churn)), 6) AS brier FROM scored GROUP BY segment"))
def brier_by_segment(spark, sf):
    return r6(M.brier(scored(spark, sf), "churn", "p", ["segment"]), "brier")


@query(
    "accuracy_by_segment",
    churn_sql("SELECT segment, round(avg(((p > 0.5e0)::INT = churn)::INT), 6) AS accuracy FROM scored GROUP BY segment"),
)
def accuracy_by_segment(spark, sf):
    return r6(M.accuracy(scored(spark, sf), "churn", "p", ["segment"]), "accuracy")


def _ece_sql(bin_sql: str, keep: str) -> str:
    return churn_sql(
        f"""SELECT segment, round(sum(CASE WHEN {keep} THEN abs(sy - sp) ELSE 0e0 END) / sum(n), 6) AS ece FROM (
        SELECT segment, {bin_sql} AS b, count(*) AS n, sum(churn) AS sy, sum(p) AS sp FROM scored GROUP BY 1, 2) GROUP BY segment"""
    )


@query("ece_by_segment", _ece_sql(SQL_ECE_BIN, "b >= 1"))
def ece_by_segment(spark, sf):
    return r6(M.ece(scored(spark, sf), "churn", "p", ["segment"]), "ece")


@query("ece_standard_by_segment", _ece_sql(f"least({SQL_ECE_BIN}, 9)", "true"))
def ece_standard_by_segment(spark, sf):
    return r6(M.ece(scored(spark, sf), "churn", "p", ["segment"], mode="standard"), "ece")


def metrics_wide_sql(src: str, g: str) -> str:
    """The five metrics per group g, over columns (g, p, y)."""
    return f"""bins AS (SELECT {g}, {SQL_ECE_BIN} AS b, count(*) AS n, sum(y) AS sy, sum(p) AS sp FROM {src} GROUP BY {g}, b),
      e AS (SELECT {g}, sum(CASE WHEN b >= 1 THEN abs(sy - sp) ELSE 0e0 END) / sum(n) AS ece FROM bins GROUP BY {g}),
      a AS (SELECT {g}, {SQL_AUC} AS roc_auc, {SQL_AP} AS pr_auc FROM curve GROUP BY {g}),
      b AS (SELECT {g}, avg((p - y) * (p - y)) AS brier, avg(((p > 0.5e0)::INT = y)::INT) AS accuracy FROM {src} GROUP BY {g}),
      wide AS (SELECT * FROM a JOIN b USING ({g}) JOIN e USING ({g})),
      metrics AS (SELECT {g}, m AS metric, round(CASE m WHEN 'roc_auc' THEN roc_auc WHEN 'pr_auc' THEN pr_auc WHEN 'brier' THEN brier
         WHEN 'ece' THEN ece ELSE accuracy END, 6) AS value
         FROM wide, (VALUES ('roc_auc'), ('pr_auc'), ('brier'), ('ece'), ('accuracy')) v(m))"""


FOLDED = fold_sql("ys", "customer_id", 5)


@query(
    "all_metrics_by_fold",
    churn_sql(
        "SELECT fold, metric, value FROM metrics",
        ", ".join([Y_SCORED, FOLDED, curve_sql("folded", "fold"), metrics_wide_sql("folded", "fold")]),
    ),
)
def all_metrics_by_fold(spark, sf):
    f = folded(spark, sf, scored(spark, sf), 5)
    return r6(M.all_metrics(f, "churn", "p", ["fold"]), "value")


@query(
    "all_metrics_by_location",
    churn_sql(
        "SELECT location, metric, value FROM metrics",
        ", ".join([Y_SCORED, curve_sql("ys", "location"), metrics_wide_sql("ys", "location")]),
    ),
)
def all_metrics_by_location(spark, sf):
    return r6(M.all_metrics(scored(spark, sf), "churn", "p", ["location"]), "value")


@query(
    "metrics_mean_over_folds",
    churn_sql(
        "SELECT metric, round(avg(value), 5) AS mean, round(sum(value), 5) AS total, count(*) AS folds FROM metrics GROUP BY metric",
        ", ".join(
            [Y_SCORED, FOLDED, curve_sql("folded", "fold"), metrics_wide_sql("folded", "fold").replace("round(CASE m", "(CASE m").replace("END, 6) AS value", "END) AS value")]
        ),
    ),
)
def metrics_mean_over_folds(spark, sf):
    f = folded(spark, sf, scored(spark, sf), 5)
    out = M.mean_over_folds(M.all_metrics(f, "churn", "p", ["fold"]), [])
    return out.select("metric", F.round("mean", 5).alias("mean"), F.round("total", 5).alias("total"), "folds")


@query(
    "calibration_curve",
    churn_sql(
        f"""SELECT {SQL_CURVE_BIN} AS bin, round(avg(churn), 6) AS fraction_positive, round(avg(p), 6) AS mean_predicted,
        count(*) AS n FROM scored GROUP BY 1"""
    ),
)
def calibration_curve(spark, sf):
    return r6(M.calibration_curve(scored(spark, sf), "churn", "p"), "fraction_positive", "mean_predicted")


@query(
    "roc_curve_by_segment",
    churn_sql(
        """SELECT segment, p AS threshold, round(cfp / nn::DOUBLE, 6) AS fpr, round(ctp / np::DOUBLE, 6) AS tpr FROM curve
        UNION ALL SELECT DISTINCT segment, NULL::DOUBLE, 0e0, 0e0 FROM ys""",
        Y_SCORED + ", " + curve_sql("ys", "segment"),
    ),
)
def roc_curve_by_segment(spark, sf):
    return r6(M.roc_curve(scored(spark, sf), "churn", "p", ["segment"]), "fpr", "tpr")


@query(
    "roc_curve_corners",
    churn_sql(
        """SELECT p AS threshold, round(cfp / nn::DOUBLE, 6) AS fpr, round(ctp / np::DOUBLE, 6) AS tpr FROM (
          SELECT *, lead(tp) OVER (ORDER BY p DESC) AS ntp, lead(fp) OVER (ORDER BY p DESC) AS nfp FROM curve)
        WHERE ntp IS NULL OR ntp <> tp OR nfp <> fp UNION ALL SELECT NULL::DOUBLE, 0e0, 0e0""",
        Y_SCORED + ", " + curve_sql("ys"),
    ),
)
def roc_curve_corners(spark, sf):
    return r6(M.roc_curve(scored(spark, sf), "churn", "p", drop_collinear=True), "fpr", "tpr")


@query(
    "pr_curve",
    churn_sql(
        """SELECT p AS threshold, round(ctp / (ctp + cfp)::DOUBLE, 6) AS precision, round(ctp / np::DOUBLE, 6) AS recall FROM curve
        UNION ALL SELECT NULL::DOUBLE, 1e0, 0e0""",
        Y_SCORED + ", " + curve_sql("ys"),
    ),
)
def pr_curve(spark, sf):
    return r6(M.pr_curve(scored(spark, sf), "churn", "p"), "precision", "recall")


@query(
    "confusion_by_segment",
    churn_sql(
        """SELECT *, round(tp / nullif(tp + fp, 0)::DOUBLE, 6) AS precision, round(tp / nullif(tp + fn, 0)::DOUBLE, 6) AS recall,
          round(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 6) AS f1 FROM (
          SELECT segment, count(*) FILTER (WHERE p > 0.2e0 AND churn = 1) AS tp, count(*) FILTER (WHERE p > 0.2e0 AND churn = 0) AS fp,
          count(*) FILTER (WHERE p <= 0.2e0 AND churn = 1) AS fn, count(*) FILTER (WHERE p <= 0.2e0 AND churn = 0) AS tn
          FROM scored GROUP BY segment)"""
    ),
)
def confusion_by_segment(spark, sf):
    return r6(M.confusion(scored(spark, sf), "churn", "p", ["segment"], 0.2), "precision", "recall", "f1")


@query(
    "precision_recall_top_tenth",
    churn_sql(
        """SELECT segment, round(sum(tp * taken / (tp + fp)::DOUBLE) / sum(taken), 6) AS precision_top,
          round(sum(tp * taken / (tp + fp)::DOUBLE) / max(np), 6) AS recall_top, sum(taken)::BIGINT AS n_top FROM (
          SELECT *, greatest(0, least(tp + fp, ceil(0.1e0 * (np + nn)) - (ctp + cfp - tp - fp))) AS taken FROM curve) GROUP BY segment""",
        Y_SCORED + ", " + curve_sql("ys", "segment"),
    ),
)
def precision_recall_top_tenth(spark, sf):
    return r6(M.at_top(scored(spark, sf), "churn", "p", ["segment"]), "precision_top", "recall_top")


@query(
    "auc_of_raw_feature",
    "WITH ys AS (SELECT quality AS y, n_chars::DOUBLE AS p, lang FROM documents JOIN labels USING (doc_id)), "
    + curve_sql("ys", "lang")
    + f" SELECT lang, round({SQL_AUC}, 6) AS roc_auc FROM curve GROUP BY lang",
)
def auc_of_raw_feature(spark, sf):
    from tabwright.plans.frame import table

    d = table(spark, sf, "documents").select("doc_id", "lang", F.col("n_chars").cast("double").alias("n_chars"))
    d = d.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    return r6(M.roc_auc(d, "quality", "n_chars", ["lang"]), "roc_auc")


@query(
    "evaluation_bundle",
    churn_sql(
        """SELECT 'metrics' AS part, count(*) AS n FROM metrics UNION ALL
        SELECT 'roc_curve', count(*) + (SELECT count(DISTINCT segment) FROM ys) FROM curve UNION ALL
        SELECT 'pr_curve', count(*) + (SELECT count(DISTINCT segment) FROM ys) FROM curve UNION ALL
        SELECT 'calibration_curve', (SELECT count(*) FROM (SELECT DISTINCT segment, """
        + SQL_CURVE_BIN
        + " FROM ys))",
        ", ".join([Y_SCORED, curve_sql("ys", "segment"), metrics_wide_sql("ys", "segment")]),
    ),
)
def evaluation_bundle(spark, sf):
    from tabwright.session import scratch

    paths = M.write_evaluation(scored(spark, sf), "churn", "p", scratch(spark, "evaluation"), ["segment"])
    out = None
    for part, path in paths.items():
        src = spark.read.json(path) if part == "metrics" else spark.read.parquet(path)
        one = src.agg(F.count(F.lit(1)).alias("n")).select(F.lit(part).alias("part"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("churn_frame", churn_sql("SELECT * FROM churn"))
def churn_frame(spark, sf):
    return customer_churn(spark, sf)
