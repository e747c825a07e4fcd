"""The customer table derived from the given tables, one row per customer.

History before the as-of date gives the features, orders from that date on give
the label and the leaky columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.operators.split import assign_folds

ASOF = "2000-06-01"

FEATURES = ["location", "segment", "acctbal", "n_orders", "avg_total", "tenure_days", "days_since_last", "n_urgent"]
NUMERIC = ["acctbal", "n_orders", "avg_total", "tenure_days", "days_since_last", "n_urgent"]
CATEGORICAL = ["location", "segment"]
LEAKY = ["post_orders", "first_post_date"]
TARGET = "churn"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customer_churn(spark: SparkSession, sf_dir: str, asof: str = ASOF) -> DataFrame:
    """One conditional aggregation over orders, then two joins on their keys."""
    day = F.lit(asof).cast("timestamp_ntz")
    pre, post = F.col("o_orderdate") < day, F.col("o_orderdate") >= day
    history = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.count_if(pre).alias("_n"),
            F.avg(F.when(pre, F.col("o_totalprice"))).alias("_avg"),
            F.min(F.when(pre, F.col("o_orderdate"))).alias("_first"),
            F.max(F.when(pre, F.col("o_orderdate"))).alias("_last"),
            F.count_if(pre & (F.col("o_orderpriority") == "1-URGENT")).alias("_urgent"),
            F.count_if(post).alias("_post"),
            F.min(F.when(post, F.col("o_orderdate"))).alias("first_post_date"),
        )
    )
    base = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    had = F.col("_n") > 0
    out = base.join(history, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("n_name").alias("location"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("acctbal"),
        F.when(had, F.col("_n")).alias("n_orders"),
        F.round("_avg", 6).alias("avg_total"),
        F.datediff(day.cast("date"), F.col("_first").cast("date")).cast("long").alias("tenure_days"),
        F.datediff(day.cast("date"), F.col("_last").cast("date")).cast("long").alias("days_since_last"),
        F.when(had, F.col("_urgent")).alias("n_urgent"),
        F.when(F.col("_post") > 0, F.col("_post")).alias("post_orders"),
        F.col("first_post_date"),
        (F.coalesce(F.col("_post"), F.lit(0)) == 0).cast("int").alias("churn"),
    )
    return out


def customer_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of the frame straight from their table."""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))


def folded(spark: SparkSession, sf_dir: str, df: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    return assign_folds(df, "customer_id", k, seed, keys=customer_keys(spark, sf_dir))


def with_score(df: DataFrame) -> DataFrame:
    """Add the closed-form score ``p`` (two digits, so it is full of ties)."""
    z = (
        F.lit(-1.5)
        + F.lit(0.3) * F.coalesce("n_urgent", F.lit(0))
        + F.col("acctbal") / F.lit(10000.0)
        - F.lit(0.05) * F.coalesce("n_orders", F.lit(0))
    )
    return df.withColumn("p", F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), 2))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_score(customer_churn(spark, sf_dir))


CHURN_SQL = f"""
pre AS (
  SELECT o_custkey, count(*) AS n_orders, round(avg(o_totalprice), 6) AS avg_total,
         min(o_orderdate) AS first_dt, max(o_orderdate) AS last_dt,
         count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_urgent
  FROM orders WHERE o_orderdate < TIMESTAMP '{ASOF}' GROUP BY o_custkey),
post AS (
  SELECT o_custkey, count(*) AS post_orders, min(o_orderdate) AS first_post_date
  FROM orders WHERE o_orderdate >= TIMESTAMP '{ASOF}' GROUP BY o_custkey),
churn AS (
  SELECT c_custkey AS customer_id, n_name AS location, c_mktsegment AS segment, c_acctbal AS acctbal,
         pre.n_orders, pre.avg_total,
         date_diff('day', first_dt, TIMESTAMP '{ASOF}') AS tenure_days,
         date_diff('day', last_dt, TIMESTAMP '{ASOF}') AS days_since_last,
         pre.n_urgent, post.post_orders, post.first_post_date,
         CASE WHEN post.post_orders IS NULL THEN 1 ELSE 0 END AS churn
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN pre ON pre.o_custkey = c_custkey LEFT JOIN post ON post.o_custkey = c_custkey),
scored AS (
  SELECT *, round(1e0 / (1e0 + exp(-(-1.5e0 + 0.3e0 * coalesce(n_urgent, 0) + acctbal / 10000e0
                                     - 0.05e0 * coalesce(n_orders, 0)))), 2) AS p
  FROM churn)
"""


def churn_sql(tail: str, more: str = "") -> str:
    """A query over ``churn`` / ``scored``; ``more`` adds further named steps."""
    return "WITH " + CHURN_SQL + (", " + more if more else "") + "\n" + tail
