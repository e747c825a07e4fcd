"""Class codes and target means as a table: the fitted state of categorical features, whatever their number of classes."""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.operators.joins import lookup

#: Bytes of a feature's classes that may be broadcast; more are looked up through a shuffle.
BROADCAST_BYTES = 4 << 20
#: What a class takes beside its text.
ROW_BYTES = 32

#: One row per class: which feature, its value as text, place in the sorted classes, training rows, target mean.
SCHEMA = "feature string, value string, code int, n bigint, mean double"


class ClassTable(Transformer, MLReadable, MLWritable):
    """Adds ``<feature>__j`` (code) or ``<feature>__t`` (target mean) by looking ``<feature>__s`` up in a written table.

    ``layout`` says per feature which of the two, what an unknown value gets, and how many classes and bytes there are. A feature
    of few bytes is joined by broadcast; a larger one by ``lookup``, which spreads hot and null values. The table is copied
    when the stage is saved.
    """

    layout = Param(Params._dummy(), "layout", "features as JSON: kind, other, classes, bytes", typeConverter=TypeConverters.toString)
    path = Param(Params._dummy(), "path", "folder of the class table", typeConverter=TypeConverters.toString)
    part = Param(Params._dummy(), "part", "partition of the table that holds the classes, or nothing", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, layout: str = "{}", path: str = "", part: str = ""):
        super().__init__()
        self._setDefault(layout="{}", path="", part="")
        self._set(layout=layout, path=path, part=part)

    def table(self) -> DataFrame:
        rows = SparkSession.active().read.parquet(self.getOrDefault("path"))
        part = self.getOrDefault("part")
        return (rows.filter(part) if part else rows).select("feature", "value", "code", "n", "mean")

    def _transform(self, df: DataFrame) -> DataFrame:
        table = self.table()
        for c, f in json.loads(self.getOrDefault("layout")).items():
            key, out, field = f"{c}__s", f"{c}__{'j' if f['kind'] == 'code' else 't'}", f["kind"]
            mine = table.filter(F.col("feature") == c)
            if f["bytes"] + ROW_BYTES * f["classes"] <= BROADCAST_BYTES:
                found = df.join(F.broadcast(mine.select(F.col("value").alias(key), F.col(field).alias("_got"))), key, "left")
            else:
                plain = [x for x, t in df.dtypes if not t.startswith(("array", "map", "struct", "vector", "udt", "variant"))]
                salted = df.withColumn("_by", F.xxhash64(*[F.col(f"`{x}`") for x in plain]))
                right = mine.select(F.col("value").alias(key), F.col(field).alias("_got"), F.col("n").alias("_rows"))
                found = lookup(salted, right, [key], "_rows", "_by")
            other = F.lit(None if f["other"] is None else float(f["other"])).cast("double")
            df = found.select(*df.columns, F.coalesce(F.col("_got").cast("double"), other).alias(out))
        return df

    def write(self) -> ClassTableWriter:
        return ClassTableWriter(self)

    @classmethod
    def read(cls) -> ClassTableReader:
        return ClassTableReader(cls)


class ClassTableWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:  # noqa: N802
        super().saveImpl(path)
        self.instance.table().write.parquet(f"{path}/classes")


class ClassTableReader(DefaultParamsReader):
    def load(self, path: str) -> ClassTable:
        stage = super().load(path)
        return stage._set(path=f"{path}/classes", part="")
