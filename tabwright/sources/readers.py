"""Readers: contract tables, decision tables, request records, run tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.scalar import nan_to_null
from tabwright.sources import quoted
from tabwright.sources.contract import SPARK_TYPES, Contract

# Texts that mean "missing" in a CSV cell.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def clean_missing(df: DataFrame, texts: bool = False) -> DataFrame:
    """NaN to NULL in float columns, once at load; with ``texts``, as for CSV, NA texts to NULL too."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = nan_to_null(c)
        elif texts and isinstance(f.dataType, T.StringType) and f.name != SURPLUS:
            c = F.when(~c.isin(NA_TOKENS), c)
        out.append(c.alias(f.name))
    return df.select(*out)


def typed(c: Column, declared: str, integers: str = "long") -> Column:
    """Text to the declared type; NULL where the text does not fit."""
    if declared == "integer":
        wide = c.try_cast("double")
        if integers == "double":
            return wide
        return F.coalesce(c.try_cast("bigint"), F.when(wide == F.floor(wide), wide.try_cast("bigint")))
    if declared in ("categorical", "string") or declared not in SPARK_TYPES:
        return c
    return c.try_cast(SPARK_TYPES[declared])


def _open(reader, path: str) -> DataFrame:
    try:
        return reader(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"no table at {path}") from e
        raise ValueError(f"{path} cannot be read: {e}") from e


#: What a row has beyond the header's fields; NULL in a sound row.
SURPLUS = "_surplus"


def read_text(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A headed CSV as text columns with missing values cleaned, and the column ``_surplus``.

    Quotes inside quoted fields are doubled. Short rows are filled with NULL. With
    ``multi_line`` quoted fields may hold line breaks; files are split all the same (see :mod:`quoted`). A header is one line.
    """
    options = {"quote": '"', "escape": '"'}
    names = _open(lambda p: spark.read.options(header=True, **options).csv(p), path).columns  # the first line only
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*names, SURPLUS)])
    if not multi_line:
        raw = _open(lambda p: spark.read.schema(schema).options(header=True, **options).csv(p), path)
    else:
        fields = ", ".join(f"`{c.replace('`', '``')}` string" for c in schema.names)
        parsed = F.from_csv("value", fields, options | {"multiLine": "true"})
        raw = quoted.records(spark, path).select(parsed.alias("r")).select("r.*")
    return clean_missing(raw, texts=True)


def malformed(spark: SparkSession, path: str, text: DataFrame, multi_line: bool) -> list[str]:
    """What keeps rows from being read as they were meant; one pass, and one over the lines."""
    out = []
    n = text.agg(F.count_if(F.col(SURPLUS).isNotNull())).first()[0]
    if n:
        out.append(f"{n} rows have more fields than the header")
    if not multi_line:
        quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
        n = spark.read.text(path).agg(F.count_if(quotes % 2 == 1)).first()[0]
        if n:
            out.append(f"{n} lines open or close a quoted field that goes on in another line: read with multi_line")
    return out


def read(
    spark: SparkSession,
    path: str,
    contract: Contract,
    fmt: str = "csv",
    mode: str = "fail",
    integers: str = "long",
    multi_line: bool = False,
):
    """Load a table against its contract.

    ``fail`` raises on the first violation and returns the table; ``report``
    returns ``(table, violations)`` without raising.
    """
    from tabwright.operators import validate as V

    if mode not in ("fail", "report"):
        raise ValueError("mode must be 'fail' or 'report'")
    broken: list[str] = []
    if fmt == "csv":
        text = read_text(spark, path, multi_line)
        broken = malformed(spark, path, text, multi_line)
        checked = text.drop(SURPLUS)
        specs = contract.columns
        df = checked.select(
            *[
                (typed(F.col(f"`{c}`"), specs[c].get("type"), integers) if c in specs else F.col(f"`{c}`")).alias(c)
                for c in checked.columns
            ]
        )
    elif fmt == "parquet":
        df = clean_missing(_open(spark.read.parquet, path))
        checked = df
    else:
        raise ValueError(f"unknown format: {fmt}")
    if mode == "fail":
        if broken:
            raise ValueError(f"malformed CSV: {broken[0]}")
        V.enforce(checked, contract, text=fmt == "csv", integers=integers)
        return df
    return df, V.violations(checked, contract, text=fmt == "csv", integers=integers, broken=broken)


def load_data(spark: SparkSession, path: str, contract_path: str, fmt: str = "csv") -> DataFrame:
    """Read the contract, then the table against it; the first violation raises."""
    return read(spark, path, Contract.load(contract_path, spark), fmt)


DECISION_SCHEMA = "name string, type string, cardinality bigint, action string"


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    """The feature decision table: ``name, type, cardinality, action``."""
    try:
        return spark.read.schema(DECISION_SCHEMA).option("header", True).csv(path)
    except AnalysisException as e:
        raise FileNotFoundError(f"no decision table at {path}") from e


def read_requests(spark: SparkSession, path: str, record: str, multi_line: bool = False) -> DataFrame:
    """Score requests ``{"features": [{...}, ...]}``, one row per record."""
    src = spark.read.schema(f"features array<struct<{record}>>").option("multiLine", multi_line).json(path)
    return src.select(F.inline("features"))


def read_runs(spark: SparkSession, path: str, run: str | None = None, model: str | None = None):
    """The long metrics table, filtered by partition; ``None`` if nothing was written yet."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException:
        return None
    if run is not None:
        df = df.filter(F.col("run") == run)
    if model is not None:
        df = df.filter(F.col("model") == model)
    return df
