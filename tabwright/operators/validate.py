"""Contract checks compiled to one aggregation plus one category pass."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.scalar import percent_text
from tabwright.operators.moments import pair_correlations
from tabwright.sources.contract import Contract

VIOLATION_SCHEMA = "phase int, position int, step int, column string, rule string, severity string, observed double, message string"


def missing_columns(df: DataFrame, contract: Contract) -> list[str]:
    return sorted(set(contract.columns) - set(df.columns))


def unexpected_columns(df: DataFrame, contract: Contract) -> list[str]:
    return sorted(set(df.columns) - set(contract.columns))


def type_ok(dt: T.DataType, declared: str) -> bool:
    """Which Spark types a declared type accepts; datetime is not checked."""
    numeric = isinstance(dt, T.NumericType)
    if declared in ("integer", "float"):
        return numeric
    if declared in ("categorical", "string"):
        return isinstance(dt, T.StringType)
    if declared == "boolean":
        return isinstance(dt, (T.BooleanType, T.StringType))
    return True


# The wording of missing columns, missing values, ranges and invalid categories below,
# and how a violated type is worded per declared type.
TYPE_WORDS = {
    "integer": "integer",
    "float": "numeric",
    "categorical": "categorical",
    "boolean": "boolean or object",
    "string": "string",
}


def _struct(phase, pos, step, col, rule, severity, observed, message) -> Column:
    return F.struct(
        F.lit(phase).alias("phase"),
        F.lit(pos).alias("position"),
        F.lit(step).alias("step"),
        F.lit(col).alias("column"),
        F.lit(rule).alias("rule"),
        F.lit(severity).alias("severity"),
        observed.cast("double").alias("observed"),
        message.alias("message"),
    )


def _value(df: DataFrame, name: str, spec: dict, text: bool, integers: str) -> Column:
    from tabwright.sources.readers import typed

    c = F.col(f"`{name}`")
    return typed(c, spec.get("type"), integers) if text else c


def violations(
    df: DataFrame, contract: Contract, text: bool = False, integers: str = "long", broken: list[str] | None = None
) -> DataFrame:
    """Every contract violation as a row, in the order a fail-fast check meets them.

    With ``text`` the columns are CSV texts and types are checked per value; ``broken`` says what
    the reader found wrong with the file itself.
    """
    spark = df.sparkSession
    fixed, aggs, items = [], [], []
    for i, what in enumerate(broken or []):
        fixed.append((0, i, 0, "*", "malformed", "error", float(what.split()[0]), what))
    gone = missing_columns(df, contract)
    if gone:
        fixed.append((1, 0, 0, ",".join(gone), "required", "error", float(len(gone)), f"Missing required columns: {gone}"))
    extra = unexpected_columns(df, contract)
    if extra:
        fixed.append((2, 0, 0, ",".join(extra), "unexpected", "warning", float(len(extra)), f"the contract does not have: {extra}"))

    dts = {f.name: f.dataType for f in df.schema.fields}
    domains: dict[str, tuple[int, list]] = {}
    for pos, (name, spec) in enumerate(contract.columns.items()):
        if name not in dts:
            continue
        declared = spec.get("type")
        raw, val = F.col(f"`{name}`"), _value(df, name, spec, text, integers)
        word = TYPE_WORDS.get(declared)
        usable = True
        if word is not None and text:
            bad = F.count_if(raw.isNotNull() & val.isNull())
            aggs.append(bad.alias(f"t{pos}"))
            msg = F.concat(F.lit(f"Column '{name}' should be {word} type, "), F.col(f"t{pos}").cast("string"), F.lit(" values are not"))
            items.append((F.col(f"t{pos}") > 0, _struct(3, pos, 1, name, "type", "error", F.col(f"t{pos}"), msg)))
        elif word is not None and not type_ok(dts[name], declared):
            usable = False
            got = dts[name].simpleString()
            fixed.append((3, pos, 1, name, "type", "error", 1.0, f"Column '{name}' should be {word} type, got {got}"))
        if spec.get("missing_policy", "forbidden") == "forbidden":
            aggs.append(F.count_if(raw.isNull()).alias(f"m{pos}"))
            msg = F.concat(
                F.lit(f"Column '{name}' has "), F.col(f"m{pos}").cast("string"),
                F.lit(" missing values but missing_policy is 'forbidden'"),
            )
            items.append((F.col(f"m{pos}") > 0, _struct(3, pos, 2, name, "missing", "error", F.col(f"m{pos}"), msg)))
        if spec.get("leaky", False):
            fixed.append((3, pos, 3, name, "leaky", "warning", 1.0, f"'{name}' is leaky by the contract: keep it out of training"))
        if declared == "categorical" and "categories" in spec:
            domains[name] = (pos, list(spec["categories"]))
        if declared in ("integer", "float") and "range" in spec and usable:
            lo, hi = (float(x) for x in spec["range"])
            aggs += [F.min(val).cast("double").alias(f"lo{pos}"), F.max(val).cast("double").alias(f"hi{pos}")]
            aggs.append(F.count_if((val < lo) | (val > hi)).alias(f"r{pos}"))
            out = (F.col(f"lo{pos}") < lo) | (F.col(f"hi{pos}") > hi)
            msg = F.lit(f"Column '{name}' values outside expected range {spec['range']}")
            items.append((out, _struct(3, pos, 5, name, "range", "error", F.col(f"r{pos}"), msg)))

    parts = []
    if items:
        row = df.agg(*aggs)  # one pass, one row
        found = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), s) for c, s in items]), lambda x: x.isNotNull())
        parts.append(row.select(F.inline(found)))
    if domains:
        bad = invalid_categories(df, contract)
        per = bad.groupBy("column").agg(
            F.count(F.lit(1)).cast("double").alias("observed"),
            F.concat_ws(", ", F.sort_array(F.collect_list("value"))).alias("_all"),  # distinct values outside the domain
        )
        where = F.create_map(*[x for c, (p, _) in domains.items() for x in (F.lit(c), F.lit(p))])
        parts.append(
            per.select(
                F.lit(3).alias("phase"),
                where[F.col("column")].alias("position"),
                F.lit(4).alias("step"),
                "column",
                F.lit("category").alias("rule"),
                F.lit("error").alias("severity"),
                "observed",
                F.concat(
                    F.lit("Column '"), F.col("column"), F.lit("' has invalid categories: "),
                    F.col("_all"),
                ).alias("message"),
            )
        )
    if fixed or not parts:
        parts.insert(0, spark.createDataFrame(fixed, VIOLATION_SCHEMA))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def invalid_categories(df: DataFrame, contract: Contract) -> DataFrame:
    """``(column, value, n)`` for every non-null value outside its declared domain.

    All categorical columns go through one pass; rows within the domain are
    dropped before the shuffle.
    """
    items = []
    for name, spec in contract.columns.items():
        if name in df.columns and spec.get("type") == "categorical" and "categories" in spec:
            c = F.col(f"`{name}`")
            items.append(F.when(~c.isin(list(spec["categories"])), F.struct(F.lit(name).alias("column"), c.cast("string").alias("value"))))
    if not items:
        return df.sparkSession.createDataFrame([], "column string, value string, n bigint")
    bad = df.select(F.explode(F.filter(F.array(*items), lambda x: x.isNotNull())).alias("x"))
    return bad.groupBy("x.column", "x.value").agg(F.count(F.lit(1)).alias("n"))


def enforce(df: DataFrame, contract: Contract, text: bool = False, integers: str = "long") -> None:
    """Raise ``ValueError`` for the first error; warn about the rest of the marks."""
    gone = missing_columns(df, contract)
    if gone:
        raise ValueError(f"Missing required columns: {gone}")
    rows = violations(df, contract, text, integers).orderBy("phase", "position", "step").collect()  # few rows per column
    for r in rows:
        if r["severity"] == "error":
            raise ValueError(r["message"])
        warnings.warn(r["message"], stacklevel=2)


def missing_fractions(df: DataFrame) -> DataFrame:
    """``(column, dtype, position, rows, missing_count, missing_fraction)`` in one pass."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"_m{i}") for i, c in enumerate(df.columns)]
    items = [
        F.struct(F.lit(c).alias("column"), F.lit(t).alias("dtype"), F.lit(i).alias("position"),
                 F.col("_rows").alias("rows"), F.col(f"_m{i}").alias("missing_count"),
                 F.try_divide(F.col(f"_m{i}").cast("double"), F.col("_rows")).alias("missing_fraction"))
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*items)))


def quality_report(df: DataFrame) -> DataFrame:
    """``(column, metric, value)``: totals under column ``*``, missing shares per column."""
    f = missing_fractions(df)
    per = f.select("column", F.lit("missing_fraction").alias("metric"), F.col("missing_fraction").alias("value"))
    total = f.filter("position = 0").select(
        F.lit("*").alias("column"),
        F.inline(F.array(
            F.struct(F.lit("total_rows").alias("metric"), F.col("rows").cast("double").alias("value")),
            F.struct(F.lit("total_columns").alias("metric"), F.lit(float(len(df.columns))).alias("value")),
        )),
    )
    return per.unionByName(total)


def quality_issues(df: DataFrame, max_missing: float = 0.3) -> DataFrame:
    """Columns whose missing share is strictly above the limit, with the report line."""
    f = missing_fractions(df).filter(F.col("missing_fraction") > max_missing)
    line = F.concat(
        F.col("column"), F.lit(": "), percent_text("missing_fraction"),
        F.lit(f" missing, more than {max_missing:.1%}"),
    )
    return f.select("column", "missing_fraction", line.alias("issue"))


def low_variety(df: DataFrame, columns: list[str], min_unique: int = 2) -> DataFrame:
    """Categorical columns with fewer distinct values than required."""
    from tabwright.operators.profile import distinct_counts

    return distinct_counts(df, columns).filter(F.col("distinct") < min_unique)


def correlated_pairs(df: DataFrame, columns: list[str], limit: float = 0.95) -> DataFrame:
    """Column pairs whose absolute correlation is above the limit."""
    return correlation_pairs(df, columns).filter(F.abs("corr") > limit)


def correlation_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(a, b, corr)`` for all unordered pairs over pairwise-complete rows."""
    return pair_correlations(df, [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]])


def drop_correlated(df: DataFrame, columns: list[str], limit: float = 0.95) -> list[str]:
    """Greedy selection: keep a column unless it is too close to one kept before."""
    close = {(r["a"], r["b"]) for r in correlated_pairs(df, columns, limit).collect()}  # at most pairs of columns
    kept: list[str] = []
    for c in columns:
        if not any((k, c) in close for k in kept):
            kept.append(c)
    return kept


