"""Streaming queries: each runs the stream to the end of its input and reads the result."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.plans.catalog import query
from tabwright.plans.frame import customer_churn
from tabwright.plans.models import logistic, score
from tabwright.session import scratch
from tabwright.streaming import score as ST


def finish(q):
    q.awaitTermination()
    return q


@query(
    "stream_scored_events",
    """SELECT event_id, user_id, round(1e0 / (1e0 + exp(1e0 - value / 10e0)), 6) AS prob, (1e0 / (1e0 + exp(1e0 - value / 10e0)) >= 0.5e0)::INT AS label FROM events""",
)
def stream_scored_events(spark, sf):
    def scorer(df):
        p = 1.0 / (1.0 + F.exp(1.0 - F.col("value") / 10.0))
        return df.select("event_id", "user_id", F.round(p, 6).alias("prob"), (p >= 0.5).cast("int").alias("label"))

    out, check = scratch(spark, "stream-scores"), scratch(spark, "stream-check")
    finish(ST.score_stream(ST.table_stream(spark, sf, "events.parquet"), scorer, out, check))
    return spark.read.parquet(out).drop("batch")


@query(
    "stream_daily_usage",
    "SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
)
def stream_daily_usage(spark, sf):
    out, check = scratch(spark, "stream-usage"), scratch(spark, "stream-check")
    w = ST.usage_windows(ST.table_stream(spark, sf, "events.parquet"), "ts", ["event_type"])
    finish(ST.write_batches(w, out, check, "update"))
    last = ST.latest_state(spark, out, ["start", "event_type"])
    return last.select("start", "event_type", "n", F.round("total", 4).alias("total"))


@query("stream_scored_by_saved_model")
def stream_scored_by_saved_model(spark, sf):
    """Fit and save a pipeline on the customer table, then score it as a stream."""
    from pyspark.ml import PipelineModel

    from tabwright.operators import transforms as P
    from tabwright.plans.queries_transforms import PLAN
    from tabwright.sources import sinks

    src = scratch(spark, "stream-customers")
    customer_churn(spark, sf).repartition(4).write.parquet(src)
    c = P.target_column(spark.read.parquet(src), "churn")
    prep = P.fit_preprocessing(c, PLAN, "churn")
    model = logistic().fit(prep.transform(c).select("label", "features"))
    root = sinks.export_model(PipelineModel([*prep.stages.stages, model]), scratch(spark, "stream-model"), {"model_type": "logistic"})
    loaded, _ = sinks.import_model(root)
    *stages, final = loaded.stages

    def scorer(df):
        return score(final, PipelineModel(stages).transform(df)).select("customer_id", "prob", "logit")

    out, check = scratch(spark, "stream-scores"), scratch(spark, "stream-check")
    finish(ST.score_stream(ST.table_stream(spark, src, files_per_batch=2), scorer, out, check))
    return spark.read.parquet(out).select("customer_id", "prob", "logit")


# a day of a user's events, and the days on which they leave a window, as far as the watermark has passed them
USAGE_SQL = """WITH e AS (SELECT user_id, ts::DATE AS d, count(*) AS n, count(*) FILTER (event_type = 'purchase') AS b FROM events GROUP BY 1, 2),
  done AS (SELECT (max(ts) - INTERVAL 2 DAYS)::DATE - 1 AS last FROM events),
  points AS (SELECT DISTINCT user_id, d + x AS day FROM e, (VALUES (0), (30), (90)) v(x), done WHERE d + x <= last)
  SELECT p.user_id, p.day::DATE AS day, coalesce(sum(n) FILTER (d > p.day - 30), 0)::BIGINT AS events_30d, coalesce(sum(b), 0)::BIGINT AS purchases_90d
  FROM points p LEFT JOIN e ON e.user_id = p.user_id AND d <= p.day AND d > p.day - 90 GROUP BY 1, 2"""


def in_order(df, ts, files, src):
    """Write ``df`` as files in the order of time, as they would arrive: a stream takes files by when they were written, so one is written after the other."""
    cut = scratch(df.sparkSession, "stream-slices")
    df.repartitionByRange(files, ts).withColumn("_slice", F.spark_partition_id()).write.partitionBy("_slice").parquet(cut)
    slices = df.sparkSession.read.schema(T.StructType([*df.schema, T.StructField("_slice", T.IntegerType())])).parquet(cut)
    for i in range(files):
        slices.filter(F.col("_slice") == i).drop("_slice").coalesce(1).write.mode("append").parquet(src)


@query("stream_running_usage", USAGE_SQL)
def stream_running_usage(spark, sf):
    """Events of 30 and purchases of 90 days, kept up to date by a stream of several batches."""
    from tabwright.streaming.usage import running_usage

    src, out, check = scratch(spark, "stream-events"), scratch(spark, "stream-running"), scratch(spark, "stream-check")
    in_order(spark.read.parquet(f"{sf}/events.parquet"), "ts", 6, src)
    counts = {"events_30d": (30, F.lit(True)), "purchases_90d": (90, F.col("event_type") == "purchase")}
    usage = running_usage(ST.table_stream(spark, src, files_per_batch=2), "user_id", "ts", counts)
    finish(ST.write_batches(usage, out, check))
    return spark.read.parquet(out).drop("batch")
