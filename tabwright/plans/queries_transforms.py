"""Preprocessing queries: statistics, encodings, fold-safe parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.operators import split as S
from tabwright.operators import transforms as P
from tabwright.operators.joins import lookup
from tabwright.plans.catalog import query
from tabwright.plans.contracts import CHURN
from tabwright.plans.frame import NUMERIC, churn_sql, customer_churn, folded, table
from tabwright.plans.queries_metrics import fold_sql, r6
from tabwright.plans.queries_profile import long_sql

LONG = f"long AS ({long_sql(NUMERIC).replace(chr(34) + 'column' + chr(34), 'feature')})"


def _fit_sql(fill: str) -> str:
    return churn_sql(
        """SELECT feature, round(fill, 6) AS fill, round(avg(coalesce(v, fill)), 6) AS mean,
        round(CASE WHEN stddev_pop(coalesce(v, fill)) > 0 THEN stddev_pop(coalesce(v, fill)) ELSE 1e0 END, 6) AS std
        FROM long JOIN fills USING (feature) GROUP BY feature, fill""",
        LONG + f", fills AS (SELECT feature, {fill} AS fill FROM long GROUP BY feature)",
    )


def _fit(spark, sf, strategy):
    return r6(P.fit_numeric(customer_churn(spark, sf), NUMERIC, strategy).select("feature", "fill", "mean", "std"), "fill", "mean", "std")


@query("impute_scale_fit_mean", _fit_sql("avg(v)"))
def impute_scale_fit_mean(spark, sf):
    return _fit(spark, sf, "mean")


@query("impute_scale_fit_median", _fit_sql("median(v)"))
def impute_scale_fit_median(spark, sf):
    return _fit(spark, sf, "median")


MODE_SQL = "(SELECT v FROM (SELECT feature f2, v, count(*) c FROM long WHERE v IS NOT NULL GROUP BY 1, 2) WHERE f2 = long.feature ORDER BY c DESC, v LIMIT 1)"


@query("impute_scale_fit_mode", _fit_sql(MODE_SQL))
def impute_scale_fit_mode(spark, sf):
    return _fit(spark, sf, "most_frequent")


@query(
    "impute_scale_fit_contract",
    _fit_sql("CASE WHEN feature IN ('avg_total', 'tenure_days', 'days_since_last') THEN median(v) ELSE 0e0 END"),
)
def impute_scale_fit_contract(spark, sf):
    return _fit(spark, sf, {c: P.POLICY_STRATEGY[CHURN.policy(c)] for c in NUMERIC})


@query(
    "scaled_features",
    churn_sql(
        "SELECT customer_id, "
        + ", ".join(
            f"round((coalesce({c}::DOUBLE, avg({c}) OVER ()) - avg({c}) OVER ()) / "
            f"(SELECT stddev_pop(coalesce({c}::DOUBLE, m)) FROM churn, (SELECT avg({c}) AS m FROM churn)), 6) AS {c}_z"
            for c in NUMERIC
        )
        + " FROM churn"
    ),
)
def scaled_features(spark, sf):
    c = customer_churn(spark, sf)
    z = [n + "_z" for n in NUMERIC]
    return r6(P.scale_columns(c, P.fit_numeric(c, NUMERIC), NUMERIC).select("customer_id", *z), *z)


@query(
    "fold_safe_numeric_stats",
    churn_sql(
        """SELECT i::INT AS fold, feature, count(v) AS n, round(avg(v), 6) AS mean,
        round(stddev_pop(v) * sqrt(count(v) / count(*)::DOUBLE), 6) AS std FROM longf, range(5) r(i) WHERE fold <> i GROUP BY 1, 2""",
        fold_sql("churn", "customer_id", 5)
        + ", longf AS ("
        + " UNION ALL ".join(f"SELECT fold, '{c}' AS feature, {c}::DOUBLE AS v FROM folded" for c in NUMERIC)
        + ")",
    ),
)
def fold_safe_numeric_stats(spark, sf):
    f = folded(spark, sf, customer_churn(spark, sf), 5)
    return r6(P.fold_numeric(f, NUMERIC).select("fold", "feature", "n", "mean", "std"), "mean", "std")


CAT = ["location", "segment", "n_urgent"]


def cat_long_sql(cols, src: str, extra: str = "") -> str:
    return " UNION ALL ".join(f"SELECT {extra}'{c}' AS feature, {c}::VARCHAR AS value FROM {src}" for c in cols)


@query(
    "vocabulary",
    churn_sql(
        """SELECT feature, value, (row_number() OVER (PARTITION BY feature ORDER BY CASE WHEN feature = 'n_urgent' THEN value::BIGINT END, value) - 1)::INT AS code, n
        FROM (SELECT feature, value, count(*) AS n FROM cl WHERE value IS NOT NULL GROUP BY 1, 2)""",
        f"cl AS ({cat_long_sql(CAT, 'churn')})",
    ),
)
def vocabulary(spark, sf):
    return P.vocabulary(P.category_counts(customer_churn(spark, sf), CAT), ["n_urgent"])


@query(
    "fold_safe_vocabulary",
    churn_sql(
        """SELECT i::INT AS fold, feature, value, count(*) AS n FROM cl, range(5) r(i) WHERE fold <> i AND value IS NOT NULL GROUP BY 1, 2, 3""",
        fold_sql("churn", "customer_id", 5) + f", cl AS ({cat_long_sql(CAT, 'folded', 'fold, ')})",
    ),
)
def fold_safe_vocabulary(spark, sf):
    f = folded(spark, sf, customer_churn(spark, sf), 5)
    return P.fold_categories(f, CAT, "fold", 5)


# the vocabulary is fitted on customers of a high balance, the rest are scored
ENC = ["location", "n_urgent"]
ENC_SQL = f"""cl AS ({cat_long_sql(ENC, "churn WHERE acctbal > 9000")}),
  voc AS (SELECT feature, value, n, (row_number() OVER (PARTITION BY feature ORDER BY CASE WHEN feature = 'n_urgent' THEN value::BIGINT END, value) - 1)::INT AS code
          FROM (SELECT feature, value, count(*) AS n FROM cl WHERE value IS NOT NULL GROUP BY 1, 2)),
  rows_ AS ({cat_long_sql(ENC, "churn WHERE acctbal <= 9000", "customer_id, ")}),
  tmode AS (SELECT feature, arg_min(value, (-n, value)) AS mode FROM voc GROUP BY feature),
  bmode AS (SELECT feature, arg_min(value, (-n, value)) AS mode FROM (SELECT feature, value, count(*) AS n FROM rows_ WHERE value IS NOT NULL GROUP BY 1, 2) GROUP BY feature)"""


def _encode(spark, sf, unknown):
    c = customer_churn(spark, sf).select("customer_id", "acctbal", *ENC)
    voc = P.vocabulary(P.category_counts(c.filter("acctbal > 9000"), ENC), ["n_urgent"])
    return P.encode_long(c.filter("acctbal <= 9000"), "customer_id", ENC, voc, unknown)


@query(
    "onehot_unknown_zeros",
    churn_sql("SELECT customer_id, feature, value, code FROM rows_ LEFT JOIN voc USING (feature, value)", ENC_SQL),
)
def onehot_unknown_zeros(spark, sf):
    return _encode(spark, sf, "zeros")


def _mode_sql(mode: str) -> str:
    return churn_sql(
        f"""SELECT customer_id, feature, CASE WHEN v.code IS NULL THEN mode ELSE r.value END AS value, coalesce(v.code, m.code) AS code
        FROM rows_ r LEFT JOIN voc v USING (feature, value) JOIN {mode} b USING (feature) LEFT JOIN voc m ON m.feature = r.feature AND m.value = mode""",
        ENC_SQL,
    ).replace("SELECT customer_id, feature,", "SELECT customer_id, r.feature AS feature,")


@query("onehot_unknown_train_mode", _mode_sql("tmode"))
def onehot_unknown_train_mode(spark, sf):
    return _encode(spark, sf, "train_mode")


@query("onehot_unknown_batch_mode", _mode_sql("bmode"))
def onehot_unknown_batch_mode(spark, sf):
    return _encode(spark, sf, "batch_mode")


@query(
    "unknown_category_counts",
    churn_sql(
        "SELECT feature, count(*) FILTER (WHERE code IS NULL) AS unknown FROM rows_ LEFT JOIN voc USING (feature, value) GROUP BY feature",
        ENC_SQL,
    ),
)
def unknown_category_counts(spark, sf):
    c = customer_churn(spark, sf).select("customer_id", "acctbal", *ENC)
    voc = P.vocabulary(P.category_counts(c.filter("acctbal > 9000"), ENC), ["n_urgent"])
    return P.unknown_counts(c.filter("acctbal <= 9000"), ENC, voc)


@query(
    "target_to_label",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label FROM orders",
)
def target_to_label(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", 1.0).when(F.col("o_orderstatus") == "O", 0.0).alias("t")
    )
    return P.target_column(o, "t", "zero").select("o_orderkey", "label")


@query(
    "target_encoding_by_fold",
    churn_sql(
        """SELECT i::INT AS fold, feature, value, count(*) AS n, round(avg(churn), 6) AS encoded FROM cl, range(5) r(i)
        WHERE fold <> i AND value IS NOT NULL GROUP BY 1, 2, 3""",
        fold_sql("churn", "customer_id", 5) + f", cl AS ({cat_long_sql(['location', 'segment'], 'folded', 'fold, churn, ')})",
    ),
)
def target_encoding_by_fold(spark, sf):
    f = folded(spark, sf, customer_churn(spark, sf), 5)
    return r6(P.target_encoding(f, ["location", "segment"], "churn", "fold", 5), "encoded")


@query(
    "target_encoded_rows",
    churn_sql(
        """SELECT f.customer_id, round(coalesce(e.encoded, q.prior), 6) AS location_te FROM folded f
        JOIN (SELECT i::INT AS fold, avg(churn) AS prior FROM folded, range(5) r(i) WHERE fold <> i GROUP BY 1) q USING (fold)
        LEFT JOIN (SELECT i::INT AS fold, location, avg(churn) AS encoded FROM folded, range(5) r(i) WHERE fold <> i GROUP BY 1, 2) e USING (fold, location)""",
        fold_sql("churn", "customer_id", 5),
    ),
)
def target_encoded_rows(spark, sf):
    f = folded(spark, sf, customer_churn(spark, sf).select("customer_id", "location", "churn"), 5)
    enc = P.target_encoding(f, ["location"], "churn", "fold", 5).select("fold", F.col("value").alias("location"), "n", "encoded")
    out = f.join(F.broadcast(P.target_prior(f, "churn", "fold")), "fold")  # one row per fold
    out = lookup(out, enc, ["fold", "location"], "n", "customer_id")
    return out.select("customer_id", F.round(F.coalesce("encoded", "prior"), 6).alias("location_te"))


PLAN = {
    "acctbal": "scale", "n_orders": "scale", "avg_total": "scale", "tenure_days": "scale",
    "days_since_last": "scale", "n_urgent": "onehot", "segment": "onehot", "location": "embed",
}


@query(
    "fitted_feature_info",
    churn_sql(
        " UNION ALL ".join(
            f"SELECT DISTINCT '{c}' AS feature, '{a}' AS action, "
            + ("NULL::BIGINT" if a == "scale" else f"count(DISTINCT {c})")
            + " AS vocabulary_size FROM churn"
            for c, a in PLAN.items()
        )
    ),
)
def fitted_feature_info(spark, sf):
    p = P.fit_preprocessing(customer_churn(spark, sf), PLAN, "churn")
    return spark.createDataFrame(p.info(), "feature string, action string, vocabulary_size bigint")


@query(
    "assembled_features",
    churn_sql(
        """SELECT customer_id, i::INT AS slot, round(CASE WHEN i = 0 THEN (acctbal - m.mu) / m.sd ELSE 1e0 END, 6) AS value
        FROM churn, (SELECT avg(acctbal) AS mu, stddev_pop(acctbal) AS sd FROM churn) m, range(31) r(i)
        LEFT JOIN seg s ON s.slot = i LEFT JOIN loc l ON l.slot = i
        WHERE i = 0 OR s.segment = churn.segment OR l.location = churn.location""",
        """seg AS (SELECT segment, row_number() OVER (ORDER BY segment) AS slot FROM (SELECT DISTINCT segment FROM churn)),
        loc AS (SELECT location, (SELECT count(*) FROM seg) + row_number() OVER (ORDER BY location) AS slot FROM (SELECT DISTINCT location FROM churn))""",
    ),
)
def assembled_features(spark, sf):
    """The assembled vector in long form: non-zero slots of every row."""
    from pyspark.ml.functions import vector_to_array

    c = customer_churn(spark, sf)
    p = P.fit_preprocessing(c, {"acctbal": "scale", "segment": "onehot", "location": "embed"}, "churn")
    v = p.transform(c).select("customer_id", F.posexplode(vector_to_array("features")).alias("slot", "value"))
    return v.filter("value <> 0").select("customer_id", "slot", F.round("value", 6).alias("value"))


@query(
    "hashed_features",
    churn_sql("SELECT customer_id, 65 AS width, 1 AS hot FROM churn"),
)
def hashed_features(spark, sf):
    """A feature whose action is to be hashed; (key, block width, non-zeros)."""
    from pyspark.ml.functions import vector_to_array

    c = customer_churn(spark, sf)
    p = P.fit_preprocessing(c, {"acctbal": "scale", "location": "hash"}, "churn", hash_size=64)
    v = p.transform(c).select("customer_id", vector_to_array("features").alias("v"))
    return v.select("customer_id", F.size("v").alias("width"), F.size(F.filter(F.slice("v", 2, 64), lambda x: x != 0)).alias("hot"))


@query(
    "identifier_target_encoding",
    """SELECT l_orderkey, l_linenumber, round(avg((l_returnflag = 'R')::INT) OVER (PARTITION BY l_orderkey), 6) AS rate FROM lineitem""",
)
def identifier_target_encoding(spark, sf):
    """An identifier with a class per few rows is target-encoded like any other feature."""
    from pyspark.ml.functions import vector_to_array

    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_returnflag") == "R").cast("int").alias("returned"))
    p = P.fit_preprocessing(l, {"l_orderkey": "target_encode"}, "returned")
    return p.transform(l).select("l_orderkey", "l_linenumber", F.round(vector_to_array("features")[0], 6).alias("rate"))


@query(
    "pipeline_target_encoding",
    churn_sql("SELECT customer_id, round(avg(churn) OVER (PARTITION BY location), 6) AS location_rate FROM churn"),
)
def pipeline_target_encoding(spark, sf):
    """Target encoding as a stage of the fitted pipeline."""
    from pyspark.ml.functions import vector_to_array

    c = customer_churn(spark, sf)
    p = P.fit_preprocessing(c, {"location": "target_encode"}, "churn")
    return p.transform(c).select("customer_id", F.round(vector_to_array("features")[0], 6).alias("location_rate"))


@query(
    "contract_policy_features",
    churn_sql(
        """SELECT customer_id, i::INT AS slot, round((x[i + 1] - u[i + 1]) / d[i + 1], 6) AS value FROM (
          SELECT customer_id, [coalesce(acctbal, 0e0), coalesce(avg_total, a), coalesce(tenure_days, t), coalesce(n_urgent, 0)::DOUBLE] AS x FROM churn, med), m, range(4) r(i)""",
        """med AS (SELECT median(avg_total) AS a, median(tenure_days) AS t FROM churn),
        full_ AS (SELECT coalesce(acctbal, 0e0) AS b, coalesce(avg_total, a) AS a, coalesce(tenure_days, t) AS t, coalesce(n_urgent, 0) AS g FROM churn, med),
        m AS (SELECT [avg(b), avg(a), avg(t), avg(g)] AS u, [stddev_pop(b), stddev_pop(a), stddev_pop(t), stddev_pop(g)] AS d FROM full_)""",
    ),
)
def contract_policy_features(spark, sf):
    """A fitted pipeline that fills missing numbers as the contract declares: zero or median."""
    from pyspark.ml.functions import vector_to_array

    c = customer_churn(spark, sf)
    plan = dict.fromkeys(["acctbal", "avg_total", "tenure_days", "n_urgent"], "scale")
    p = P.fit_preprocessing(c, plan, "churn", policy="contract", contract=CHURN)
    v = p.transform(c).select("customer_id", F.posexplode(vector_to_array("features")).alias("slot", "value"))
    return v.select("customer_id", "slot", F.round("value", 6).alias("value"))
