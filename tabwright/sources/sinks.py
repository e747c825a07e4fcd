"""Writers: out-of-fold scores, metrics, comparisons, decisions, models."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OOF_COLUMNS = ["run", "model", "key", "fold", "y_true", "prob", "prob_cal"]


def _write_runs(df: DataFrame, path: str, mode: str) -> None:
    """``replace`` puts the run's models in place of what was written of them before; other runs stay."""
    out = df.write.partitionBy("run", "model")
    if mode == "replace":
        out = out.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        out = out.mode(mode)
    out.parquet(path)


def write_oof(df: DataFrame, path: str, mode: str = "replace") -> None:
    """Out-of-fold scores of all models in one schema, partitioned by run and model. A run written again replaces itself."""
    _write_runs(df.select(*OOF_COLUMNS), path, mode)


METRIC_COLUMNS = ["run", "model", "scope", "fold", "metric", "value", "text"]


def write_metrics(df: DataFrame, path: str, mode: str = "replace") -> None:
    """The long run table ``(run, model, scope, fold, metric, value, text)``. A run written again replaces itself."""
    _write_runs(df.select(*METRIC_COLUMNS), path, mode)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_decisions(df: DataFrame, path: str) -> None:
    write_csv(df.select("name", "type", "cardinality", "action"), path)


def export_model(model: PipelineModel, path: str, metadata: dict, version: str = "1") -> str:
    """Save a fitted pipeline with its metadata under ``path/version``."""
    spark = SparkSession.active()
    root = f"{path}/{version}"
    model.write().overwrite().save(f"{root}/model")
    row = spark.createDataFrame([(json.dumps({**metadata, "version": version}),)], "value string")
    row.coalesce(1).write.mode("overwrite").text(f"{root}/metadata")
    return root


def import_model(root: str) -> tuple[PipelineModel, dict]:
    spark = SparkSession.active()
    meta = spark.read.text(f"{root}/metadata").agg(F.first("value")).first()[0]
    return PipelineModel.load(f"{root}/model"), json.loads(meta)
