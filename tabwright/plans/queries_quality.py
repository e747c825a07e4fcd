"""Queries over sources, sinks, contract checks and scalar expressions."""

from __future__ import annotations

import warnings

from pyspark.sql import functions as F

from tabwright.functions import scalar as X
from tabwright.operators import compare as R
from tabwright.operators import metrics as M
from tabwright.operators import profile as D
from tabwright.operators import split as S
from tabwright.operators import validate as V
from tabwright.plans.catalog import query
from tabwright.plans.contracts import CHURN, STRICT
from tabwright.plans.frame import churn_sql, customer_churn, folded, scored, table
from tabwright.plans.queries_metrics import curve_sql, fold_sql, metrics_wide_sql, r6
from tabwright.session import scratch, settle
from tabwright.sources import readers, sinks

FRAME_COLUMNS = list(CHURN.columns)


# ---------------------------------------------------------------- sources, sinks


@query("scan_contract_csv", churn_sql("SELECT * EXCLUDE (churn), churn::DOUBLE AS churn FROM churn"))
def scan_contract_csv(spark, sf):
    path = scratch(spark, "customers-csv")
    sinks.write_csv(customer_churn(spark, sf), path)
    return readers.read(spark, path, CHURN)


@query("loaded_by_contract_file", churn_sql("SELECT * EXCLUDE (churn), churn::DOUBLE AS churn FROM churn"))
def loaded_by_contract_file(spark, sf):
    """The table and its contract both come from files; the first violation would raise."""
    path, contract = scratch(spark, "customers-csv"), scratch(spark, "contract")
    sinks.write_csv(customer_churn(spark, sf), path)
    CHURN.save(contract, spark)
    return readers.load_data(spark, path, contract)


@query(
    "first_violation",
    churn_sql(
        """SELECT 'columns' AS damage, 'Missing required columns: [''acctbal'', ''segment'']' AS message
        UNION ALL SELECT 'missing', 'Column ''n_orders'' has ' || count(*) FILTER (n_orders IS NULL) || ' missing values but missing_policy is ''forbidden''' FROM churn
        UNION ALL SELECT 'range', CASE WHEN min(acctbal) < 0 OR max(acctbal) > 9000 THEN 'Column ''acctbal'' values outside expected range [0.0, 9000.0]' ELSE '' END FROM churn
        UNION ALL SELECT 'none', ''"""
    ),
)
def first_violation(spark, sf):
    """What stops a load: a missing column before anything else, then columns in their order, missing values before ranges."""
    from dataclasses import replace

    c = settle(customer_churn(spark, sf), "customers")
    narrow = {"acctbal": {**CHURN.features["acctbal"], "range": [0.0, 9000.0]}}
    strict = {"n_orders": {**CHURN.features["n_orders"], "missing_policy": "forbidden"}}
    first = {**strict, **{k: v for k, v in CHURN.features.items() if k not in strict}, **narrow}
    cases = {
        "columns": (c.drop("segment", "acctbal"), replace(CHURN, features={**CHURN.features, **strict})),
        "missing": (c, replace(CHURN, features=first)),
        "range": (c, replace(CHURN, features={**CHURN.features, **narrow})),
        "none": (c, CHURN),
    }
    out = []
    for name, (df, contract) in cases.items():
        try:
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                V.enforce(df, contract)
            out.append((name, ""))
        except ValueError as e:
            out.append((name, str(e)))
    return spark.createDataFrame(out, "damage string, message string")


@query(
    "folds_repeat",
    churn_sql("SELECT customer_id, fold, true AS same FROM folded", fold_sql("churn", "customer_id", 5)),
)
def folds_repeat(spark, sf):
    """One seed gives one assignment, however the rows lie; compared key by key."""
    c = customer_churn(spark, sf)
    a = folded(spark, sf, c).select("customer_id", "fold")
    b = S.assign_folds(c.repartition(7, "acctbal").select("customer_id"), "customer_id", 5, 42).select("customer_id", F.col("fold").alias("again"))
    return a.join(b, "customer_id").select("customer_id", "fold", (F.col("fold") == F.col("again")).alias("same"))


@query("scan_contract_parquet", churn_sql("SELECT segment, count(*) AS n, count(n_orders) AS n_known FROM churn GROUP BY segment"))
def scan_contract_parquet(spark, sf):
    path = scratch(spark, "customers-parquet")
    customer_churn(spark, sf).write.parquet(path)
    df, _ = readers.read(spark, path, CHURN, fmt="parquet", mode="report")
    return df.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.count("n_orders").alias("n_known"))


@query(
    "csv_type_violations",
    """SELECT 'price' AS "column", 'type' AS rule, count(*)::DOUBLE AS observed FROM orders WHERE o_totalprice <> floor(o_totalprice) HAVING count(*) > 0
    UNION ALL SELECT 'priority', 'type', count(*)::DOUBLE FROM orders HAVING count(*) > 0
    UNION ALL SELECT 'status', 'missing', count(*)::DOUBLE FROM orders WHERE o_orderstatus = 'P' HAVING count(*) > 0""",
)
def csv_type_violations(spark, sf):
    from tabwright.sources.contract import Contract

    path = scratch(spark, "orders-csv")
    text = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("priority"),
        F.when(F.col("o_orderstatus") == "P", "N/A").otherwise(F.col("o_orderstatus")).alias("status"),
        F.col("o_orderdate").alias("day"),
    )
    sinks.write_csv(text, path)
    kinds = {"id": "integer", "price": "integer", "priority": "float", "status": "categorical"}
    contract = Contract.from_dict(
        {
            "features": {c: {"type": t, "missing_policy": "forbidden"} for c, t in kinds.items()},
            "target": {"day": {"type": "datetime", "missing_policy": "forbidden"}},
        }
    )
    _, bad = readers.read(spark, path, contract, mode="report")
    return bad.filter("severity = 'error'").select("column", "rule", "observed")


def _text_contract():
    from tabwright.sources.contract import Contract

    kinds = {"doc_id": "integer", "text": "string", "lang": "string", "source": "string"}
    features = {c: {"type": t, "missing_policy": "allow"} for c, t in kinds.items()}
    return Contract.from_dict({"features": features, "target": {"n_chars": {"type": "integer", "missing_policy": "allow"}}})


# Fixed values in the SQL twin: the texts that mean "missing" in a CSV cell, as in the reader.
@query(
    "csv_quoted_text",
    """SELECT doc_id, md5(t) AS digest, length(t) AS n FROM (SELECT doc_id, 'say "' || replace(text, ' ', '", ') || '"' AS t FROM documents)""",
)
def csv_quoted_text(spark, sf):
    """Texts with line breaks, commas and quotes survive a CSV file."""
    path = scratch(spark, "documents-csv")
    docs = table(spark, sf, "documents")
    spiked = F.concat(F.lit('say "'), F.replace("text", F.lit(" "), F.lit('", ')), F.lit('"'))
    out = docs.select("doc_id", spiked.alias("text"), "lang", "source", "n_chars")
    out.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    df = readers.read(spark, path, _text_contract(), multi_line=True)
    return df.select("doc_id", F.md5("text").alias("digest"), F.length("text").cast("bigint").alias("n"))


@query(
    "csv_malformed_report",
    """SELECT 'malformed' AS rule, count(*)::DOUBLE AS observed FROM orders WHERE o_orderstatus = 'P' HAVING count(*) > 0""",
)
def csv_malformed_report(spark, sf):
    """Rows with a field too many are counted in report mode, not cut."""
    from tabwright.sources.contract import Contract

    path = scratch(spark, "orders-broken")
    line = F.concat_ws(",", "o_orderkey", "o_orderstatus", F.when(F.col("o_orderstatus") == "P", F.lit("extra")))
    # whole lines as one field of a separator that no line has: every part file gets its own header
    table(spark, sf, "orders").select(line.alias("id,status")).write.options(header=True, sep="\x01", quote="").csv(path)
    spec = {"type": "string", "missing_policy": "allow"}
    contract = Contract.from_dict({"features": {"id": {"type": "integer", "missing_policy": "allow"}}, "target": {"status": spec}})
    _, bad = readers.read(spark, path, contract, mode="report")
    return bad.filter("severity = 'error'").select("rule", "observed")


# action of each column under the decision rules, as SQL over the frame
def _decision_sql(tail: str) -> str:
    cols = [c for c in FRAME_COLUMNS if c != "churn"]
    kinds = dict.fromkeys(cols, "bigint") | {
        "location": "string", "segment": "string", "acctbal": "double", "avg_total": "double",
        "first_post_date": "timestamp_ntz",
    }
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, '{kinds[c]}' AS dtype, count(DISTINCT {c}) AS nunique, count(*) - count({c}) AS missing_count, "
        f"100e0 * (count(*) - count({c})) / count(*) AS missing_pct, {str(c in CHURN.leaky()).lower()} AS is_leaky, "
        f"{str(c in CHURN.training()).lower()} AS is_training FROM churn"
        for c in cols
    )
    rules = """decided AS (SELECT feature AS name, dtype AS type, nunique AS cardinality, missing_pct, is_leaky,
      CASE WHEN is_leaky THEN 'drop' WHEN dtype = 'string' AND nunique <= 10 THEN 'onehot'
           WHEN dtype = 'string' AND nunique <= 50 THEN 'target_encode' WHEN dtype = 'string' THEN 'embed'
           WHEN dtype = 'bigint' AND nunique <= 20 THEN 'onehot' WHEN dtype IN ('bigint', 'double') THEN 'scale' ELSE 'investigate' END AS action,
      CASE WHEN is_leaky THEN 'Leaky feature - only available post-label'
           WHEN dtype = 'string' AND nunique <= 10 THEN 'Low cardinality categorical (' || nunique || ' unique values)'
           WHEN dtype = 'string' AND nunique <= 50 THEN 'Medium cardinality categorical (' || nunique || ' unique values)'
           WHEN dtype = 'string' THEN 'High cardinality categorical (' || nunique || ' unique values)'
           WHEN dtype = 'bigint' AND nunique <= 20 THEN 'Integer with low cardinality (' || nunique || ' unique values)'
           WHEN dtype IN ('bigint', 'double') THEN 'Numeric feature - requires scaling' ELSE 'Unknown data type: ' || dtype END AS reason
      FROM features)"""
    return churn_sql(tail, f"features AS ({rows}), {rules}")


def decisions_of(spark, sf):
    return D.decide(D.feature_table(customer_churn(spark, sf), CHURN))


@query("decision_table_roundtrip", _decision_sql("SELECT name, type, cardinality, action FROM decided"))
def decision_table_roundtrip(spark, sf):
    path = scratch(spark, "decisions")
    sinks.write_decisions(decisions_of(spark, sf), path)
    return readers.read_decisions(spark, path)


@query("feature_analysis", _decision_sql("SELECT * REPLACE (round(missing_pct, 6) AS missing_pct) FROM features"))
def feature_analysis(spark, sf):
    return r6(D.feature_table(customer_churn(spark, sf), CHURN), "missing_pct")


@query("feature_decisions", _decision_sql("SELECT * REPLACE (round(missing_pct, 6) AS missing_pct) FROM decided"))
def feature_decisions(spark, sf):
    return r6(decisions_of(spark, sf), "missing_pct")


@query(
    "action_summary",
    _decision_sql(
        """SELECT action, max(n) AS features, string_agg(name, ', ' ORDER BY cardinality, name) FILTER (WHERE rn <= 3) AS examples FROM (
        SELECT *, row_number() OVER (PARTITION BY action ORDER BY cardinality, name) AS rn, count(*) OVER (PARTITION BY action) AS n FROM decided)
        GROUP BY action"""
    ),
)
def action_summary(spark, sf):
    return D.action_summary(decisions_of(spark, sf))


@query(
    "cardinality_bands",
    _decision_sql(
        """SELECT feature, nunique, CASE WHEN nunique > 50 THEN 'high' WHEN nunique > 10 THEN 'medium' ELSE 'low' END AS band
        FROM features"""
    ),
)
def cardinality_bands(spark, sf):
    f = D.feature_table(customer_churn(spark, sf), CHURN)
    return f.select("feature", "nunique", D.cardinality_band(F.col("nunique")).alias("band"))


@query(
    "oof_table_roundtrip",
    churn_sql(
        """SELECT 'r1' AS run, 'closed_form' AS model, customer_id AS key, fold, churn AS y_true, p AS prob, p AS prob_cal FROM folded""",
        fold_sql("scored", "customer_id", 3),
    ),
)
def oof_table_roundtrip(spark, sf):
    path = scratch(spark, "oof")
    f = folded(spark, sf, scored(spark, sf), 3)
    oof = f.select(
        F.lit("r1").alias("run"), F.lit("closed_form").alias("model"), F.col("customer_id").alias("key"), "fold",
        F.col("churn").alias("y_true"), F.col("p").alias("prob"), F.col("p").alias("prob_cal"),
    )
    sinks.write_oof(oof, path)
    return spark.read.parquet(path).select(*sinks.OOF_COLUMNS)


@query(
    "request_scan",
    churn_sql("SELECT customer_id, segment, acctbal, n_orders FROM churn"),
)
def request_scan(spark, sf):
    path = scratch(spark, "requests")
    rec = F.struct("customer_id", "segment", "acctbal", "n_orders")
    customer_churn(spark, sf).select(F.array(rec).alias("features")).write.json(path)
    return readers.read_requests(spark, path, "customer_id: bigint, segment: string, acctbal: double, n_orders: bigint")


# ------------------------------------------------------------- runs, comparison

# two closed-form scores per segment stand for the models of five runs
BALANCE_SQL = "round(1e0 / (1e0 + exp(1.5e0 - acctbal / 5000e0)), 2)"
RUNS_YS = f"""ys AS (SELECT segment AS run, 'linear' AS model, churn AS y, p FROM scored
  UNION ALL SELECT segment, 'balance', churn, {BALANCE_SQL} FROM scored)"""
RUNS_SQL = ", ".join([RUNS_YS, curve_sql("ys", "run, model"), metrics_wide_sql("ys", "run, model")])
RUN_KINDS = """kinds AS (SELECT segment AS run, 'gbdt' AS kind, max(first_post_date) AS ts FROM churn GROUP BY segment
  UNION ALL SELECT segment, 'ann', min(first_post_date) FROM churn WHERE segment <> 'MACHINERY' GROUP BY segment)"""


def run_scores(spark, sf):
    s = scored(spark, sf)
    balance = F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(1.5) - F.col("acctbal") / F.lit(5000.0))), 2)
    pair = F.array(
        F.struct(F.lit("linear").alias("model"), F.col("p").alias("p")),
        F.struct(F.lit("balance").alias("model"), balance.alias("p")),
    )
    return s.select(F.col("segment").alias("run"), F.col("churn").alias("y"), F.inline(pair))


def run_metrics(spark, sf):
    long = M.all_metrics(run_scores(spark, sf), "y", "p", ["run", "model"])
    # the balance model has calibrated results, the linear one has none
    scope = F.when(F.col("model") == "balance", "calibrated").otherwise("oof")
    return long.select(
        "run", "model", scope.alias("scope"), F.lit(None).cast("int").alias("fold"), "metric", "value",
        F.lit(None).cast("string").alias("text"),
    )


def run_kinds(spark, sf):
    c = customer_churn(spark, sf).select("segment", "first_post_date")
    a = c.groupBy(F.col("segment").alias("run")).agg(F.max("first_post_date").alias("hi"), F.min("first_post_date").alias("lo"))
    both = F.array(
        F.struct(F.lit("gbdt").alias("kind"), F.col("hi").alias("ts")),
        F.struct(F.when(F.col("run") != "MACHINERY", "ann").alias("kind"), F.col("lo").alias("ts")),
    )
    return a.select("run", F.inline(both)).filter("kind IS NOT NULL")


@query(
    "metrics_table_roundtrip",
    churn_sql("SELECT run, model, metric, value FROM metrics", RUNS_SQL),
)
def metrics_table_roundtrip(spark, sf):
    path = scratch(spark, "metrics")
    sinks.write_metrics(run_metrics(spark, sf), path)
    return r6(spark.read.parquet(path).select("run", "model", "metric", "value"), "value")


@query(
    "run_summary_scan",
    churn_sql("SELECT metric, value FROM metrics WHERE run = 'BUILDING' AND model = 'linear'", RUNS_SQL),
)
def run_summary_scan(spark, sf):
    path = scratch(spark, "metrics")
    sinks.write_metrics(run_metrics(spark, sf), path)
    return r6(readers.read_runs(spark, path, "BUILDING", "linear").select("metric", "value"), "value")


@query("latest_runs", churn_sql("SELECT kind, arg_max(run, (ts, run)) AS run FROM kinds GROUP BY kind", RUN_KINDS))
def latest_runs(spark, sf):
    return R.latest_runs(run_kinds(spark, sf))


@query(
    "matching_runs",
    churn_sql("SELECT run FROM kinds GROUP BY run HAVING count(DISTINCT kind) = 2", RUN_KINDS),
)
def matching_runs(spark, sf):
    return R.matching_runs(run_kinds(spark, sf), ["ann", "gbdt"])


SQL_WIDE_ROUND = ", ".join(f"round({m}, 6) AS {m}" for m in M.METRICS)
SQL_COMPARISON = f"""SELECT run, model, {SQL_WIDE_ROUND}, NULL::DOUBLE AS seconds_per_fold, 'none' AS calibration FROM wide"""


@query("model_comparison", churn_sql(SQL_COMPARISON, RUNS_SQL))
def model_comparison(spark, sf):
    return r6(R.compare(run_metrics(spark, sf)), *M.METRICS)


@query(
    "comparison_defaults",
    churn_sql(
        """SELECT run, model, round(roc_auc, 6) AS roc_auc, 0e0 AS pr_auc, round(brier, 6) AS brier, 1e0 AS ece, round(accuracy, 6) AS accuracy,
        NULL::DOUBLE AS seconds_per_fold, 'none' AS calibration FROM wide""",
        RUNS_SQL,
    ),
)
def comparison_defaults(spark, sf):
    kept = run_metrics(spark, sf).filter(~F.col("metric").isin("pr_auc", "ece"))
    return r6(R.compare(kept), *M.METRICS)


@query(
    "comparison_of_matching_runs",
    churn_sql(
        SQL_COMPARISON + " WHERE run IN (SELECT run FROM kinds GROUP BY run HAVING count(DISTINCT kind) = 2)",
        RUNS_SQL + ", " + RUN_KINDS,
    ),
)
def comparison_of_matching_runs(spark, sf):
    return r6(R.compare_runs(run_metrics(spark, sf), run_kinds(spark, sf), "all"), *M.METRICS)


@query(
    "comparison_of_latest_runs",
    churn_sql(
        SQL_COMPARISON + " WHERE run IN (SELECT arg_max(run, (ts, run)) FROM kinds GROUP BY kind)",
        RUNS_SQL + ", " + RUN_KINDS,
    ),
)
def comparison_of_latest_runs(spark, sf):
    return r6(R.compare_runs(run_metrics(spark, sf), run_kinds(spark, sf), "latest"), *M.METRICS)


@query(
    "comparison_csv",
    churn_sql("SELECT run, model, round(roc_auc, 4)::VARCHAR AS roc_auc FROM wide", RUNS_SQL),
)
def comparison_csv(spark, sf):
    path = scratch(spark, "comparison")
    c = R.compare(run_metrics(spark, sf))
    sinks.write_csv(c.select("run", "model", F.round("roc_auc", 4).alias("roc_auc")), path)
    return readers.read_text(spark, path).drop(readers.SURPLUS)


@query(
    "model_winner",
    churn_sql(
        "SELECT run, model, round(roc_auc, 6) AS roc_auc FROM wide QUALIFY row_number() OVER (PARTITION BY run ORDER BY roc_auc DESC, model) = 1",
        RUNS_SQL,
    ),
)
def model_winner(spark, sf):
    return r6(R.winners(R.compare(run_metrics(spark, sf))), "roc_auc")


@query(
    "pareto_front",
    churn_sql(
        """SELECT customer_id, days_since_last, acctbal FROM churn a WHERE days_since_last IS NOT NULL AND NOT EXISTS (
        SELECT 1 FROM churn b WHERE b.days_since_last >= a.days_since_last AND b.acctbal <= a.acctbal
          AND (b.days_since_last > a.days_since_last OR b.acctbal < a.acctbal))"""
    ),
)
def pareto_front(spark, sf):
    c = customer_churn(spark, sf).select("customer_id", "days_since_last", "acctbal")
    return R.pareto_front(c.filter("days_since_last IS NOT NULL"), "days_since_last", "acctbal").select(
        "customer_id", "days_since_last", "acctbal"
    )


# ------------------------------------------------------------------- validation


@query(
    "contract_violations",
    churn_sql(
        """SELECT 'customer_id' AS "column", 'x' AS rule, 0e0 AS observed FROM churn WHERE false
        UNION ALL SELECT 'days_since_last,first_post_date,n_urgent,tenure_days', 'unexpected', 4e0
        UNION ALL SELECT 'location', 'type', 1e0 UNION ALL SELECT 'post_orders', 'leaky', 1e0
        UNION ALL SELECT 'segment', 'category', count(DISTINCT segment)::DOUBLE FROM churn WHERE segment = 'HOUSEHOLD' HAVING count(*) > 0
        UNION ALL SELECT 'acctbal', 'range', count(*)::DOUBLE FROM churn WHERE acctbal < 0 OR acctbal > 9000 HAVING count(*) > 0
        UNION ALL SELECT 'n_orders', 'missing', count(*)::DOUBLE FROM churn WHERE n_orders IS NULL HAVING count(*) > 0
        UNION ALL SELECT 'avg_total', 'missing', count(*)::DOUBLE FROM churn WHERE avg_total IS NULL HAVING count(*) > 0"""
    ),
)
def contract_violations(spark, sf):
    return V.violations(customer_churn(spark, sf), STRICT).select("column", "rule", "observed")


@query(
    "invalid_categories",
    churn_sql(
        """SELECT 'segment' AS "column", segment AS value, count(*) AS n FROM churn
        WHERE segment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY') GROUP BY segment"""
    ),
)
def invalid_categories(spark, sf):
    return V.invalid_categories(customer_churn(spark, sf), STRICT)


def _missing_rows(where: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS n, count(*) - count({c}) AS m FROM churn" for c in FRAME_COLUMNS
    )


@query(
    "quality_report",
    churn_sql(
        """SELECT "column", 'missing_fraction' AS metric, round(m / n::DOUBLE, 6) AS value FROM miss
        UNION ALL SELECT '*', 'total_rows', max(n)::DOUBLE FROM miss UNION ALL SELECT '*', 'total_columns', count(*)::DOUBLE FROM miss""",
        f"miss AS ({_missing_rows()})",
    ),
)
def quality_report(spark, sf):
    return r6(V.quality_report(customer_churn(spark, sf)), "value")


@query(
    "quality_issues",
    churn_sql(
        """SELECT "column", round(m / n::DOUBLE, 6) AS missing_fraction, "column" || ': ' || printf('%.1f', 100e0 * m / n)
        || '% missing, more than 0.1%' AS issue FROM miss WHERE m / n::DOUBLE > 0.001e0""",
        f"miss AS ({_missing_rows()})",
    ),
)
def quality_issues(spark, sf):
    return r6(V.quality_issues(customer_churn(spark, sf), 0.001), "missing_fraction")


@query(
    "low_variety_columns",
    """SELECT 'constant' AS "column", 1::BIGINT AS "distinct" FROM orders GROUP BY 1
    UNION ALL SELECT * FROM (SELECT 'status' AS c, count(DISTINCT o_orderstatus) AS d FROM orders) WHERE d < 4""",
)
def low_variety_columns(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), F.lit("x").alias("constant")
    )
    return V.low_variety(o, ["status", "priority", "constant"], 4)


CORR_LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "net"]


def _line(spark, sf):
    l = table(spark, sf, "lineitem")
    net = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    return l.select("l_quantity", "l_extendedprice", "l_discount", "l_tax", net.alias("net"), F.lit(1.0).alias("flat"))


@query(
    "correlated_pairs",
    """WITH l AS (SELECT *, l_extendedprice * (1e0 - l_discount) AS net FROM lineitem)
    SELECT 'l_extendedprice' AS a, 'net' AS b, round(corr(l_extendedprice, net), 6) AS corr FROM l HAVING abs(corr(l_extendedprice, net)) > 0.95e0
    UNION ALL SELECT 'l_quantity', 'l_extendedprice', round(corr(l_quantity, l_extendedprice), 6) FROM l HAVING abs(corr(l_quantity, l_extendedprice)) > 0.95e0
    UNION ALL SELECT 'l_quantity', 'net', round(corr(l_quantity, net), 6) FROM l HAVING abs(corr(l_quantity, net)) > 0.95e0""",
)
def correlated_pairs(spark, sf):
    return r6(V.correlated_pairs(_line(spark, sf), [*CORR_LINE, "flat"], 0.95), "corr")


# ------------------------------------------------------------ scalar expressions


@query("project_training_features", churn_sql("SELECT customer_id, location, segment, acctbal, n_orders FROM churn"))
def project_training_features(spark, sf):
    from tabwright.operators.transforms import select_features

    return select_features(customer_churn(spark, sf), ["customer_id", "location", "segment", "acctbal", "n_orders"])


@query("drop_leaky_columns", churn_sql("SELECT * EXCLUDE (post_orders, first_post_date, churn) FROM churn"))
def drop_leaky_columns(spark, sf):
    return customer_churn(spark, sf).drop(*CHURN.leaky(), "churn")


@query(
    "mask_filter",
    churn_sql("SELECT customer_id, segment, acctbal FROM churn WHERE acctbal > 0 AND segment NOT IN ('BUILDING', 'MACHINERY') AND n_orders IS NOT NULL"),
)
def mask_filter(spark, sf):
    c = customer_churn(spark, sf)
    keep = (F.col("acctbal") > 0) & ~X.known_in("segment", ["BUILDING", "MACHINERY"]) & F.col("n_orders").isNotNull()
    return c.filter(keep).select("customer_id", "segment", "acctbal")


@query(
    "unknown_membership",
    churn_sql("SELECT customer_id, coalesce(n_orders IN (1, 2, 3), false) AS few FROM churn"),
)
def unknown_membership(spark, sf):
    return customer_churn(spark, sf).select("customer_id", X.known_in("n_orders", [1, 2, 3]).alias("few"))


@query(
    "conditional_clip_cast_fill",
    churn_sql(
        """SELECT customer_id, CASE WHEN acctbal < 0 THEN 'debt' WHEN acctbal < 5000 THEN 'mid' ELSE 'rich' END AS tier,
        least(greatest(acctbal, 0e0), 5000e0) AS both_ends, greatest(acctbal, 0e0) AS low_end, trunc(acctbal)::BIGINT AS whole,
        coalesce(n_orders, 0)::BIGINT AS n_filled, churn::DOUBLE AS churn_float FROM churn"""
    ),
)
def conditional_clip_cast_fill(spark, sf):
    b = F.col("acctbal")
    return customer_churn(spark, sf).select(
        "customer_id",
        F.when(b < 0, "debt").when(b < 5000, "mid").otherwise("rich").alias("tier"),
        X.clip("acctbal", 0.0, 5000.0).alias("both_ends"),
        X.clip("acctbal", 0.0).alias("low_end"),
        b.cast("bigint").alias("whole"),
        F.coalesce("n_orders", F.lit(0)).alias("n_filled"),
        F.col("churn").cast("double").alias("churn_float"),
    )


@query("head_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def head_rows(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(5)


@query("tail_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 5")
def tail_rows(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_orderkey")).limit(5)


@query(
    "score_report",
    churn_sql(
        """SELECT customer_id, (p > 0.5e0)::INT AS label_gt, (p >= 0.5e0)::INT AS label_ge, greatest(p, 1e0 - p) AS confidence,
        (p > 0.5e0)::INT = churn AS is_correct, CASE WHEN p < 0.3e0 THEN 'LOW' WHEN p < 0.7e0 THEN 'MEDIUM' ELSE 'HIGH' END AS risk,
        round(ln(p / (1e0 - p)), 6) AS logit, round(1e0 / (1e0 + exp(-ln(p / (1e0 - p)))), 6) AS back, round(churn - p, 6) AS residual,
        printf('%.1f%%', p * 100e0) AS share FROM scored"""
    ),
)
def score_report(spark, sf):
    return scored(spark, sf).select(
        "customer_id",
        X.label_at("p").alias("label_gt"),
        X.label_at("p", 0.5, ">=").alias("label_ge"),
        X.confidence("p").alias("confidence"),
        X.is_correct("churn", "p").alias("is_correct"),
        X.risk_band("p").alias("risk"),
        F.round(X.logit("p"), 6).alias("logit"),
        F.round(X.sigmoid(X.logit("p")), 6).alias("back"),
        F.round(X.residual("churn", "p"), 6).alias("residual"),
        X.percent_text("p").alias("share"),
    )
