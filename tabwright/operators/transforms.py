"""Preprocessing fitted on training rows and applied anywhere.

A fit is a handful of numbers per column, gathered for all numeric columns in
one aggregation and for all categorical columns in one (feature, value) pass.
Fold-safe statistics for every fold come from the same single pass, by combining
the parts of the other folds.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    FeatureHasher,
    OneHotEncoder,
    SQLTransformer,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.operators import rank
from tabwright.operators.classes import ClassTable
from tabwright.operators.joins import lookup
from tabwright.operators.rank import quantile_row
from tabwright.session import bucket_target, scratch, settle
from tabwright.sources.contract import Contract

# ------------------------------------------------------------------ selection


def select_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Project to the given features in their order; all must be there."""
    gone = sorted(set(features) - set(df.columns))
    if gone:
        raise ValueError(f"the table lacks features of the plan: {gone}")
    return df.select(*features)


def plan_of(decisions: DataFrame) -> dict[str, str]:
    """Decision table to ``{feature: action}``; one row per column, so small."""
    return {r["name"]: r["action"] for r in decisions.select("name", "action").collect()}


def action_of(plan: dict[str, str], feature: str) -> str:
    if feature not in plan:
        raise ValueError(f"no decision for feature {feature!r}")
    return plan[feature]


# -------------------------------------------------------------------- numeric


def numeric_moments(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., feature, n, missing, mu, var)`` over non-null values, one pass."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        v = F.col(c).cast("double")
        aggs += [F.count(v).alias(f"_n{i}"), F.avg(v).alias(f"_u{i}"), F.var_pop(v).alias(f"_v{i}")]
    items = [
        F.struct(F.lit(c).alias("feature"), F.col(f"_n{i}").alias("n"), (F.col("_rows") - F.col(f"_n{i}")).alias("missing"),
                 F.col(f"_u{i}").alias("mu"), F.col(f"_v{i}").alias("var"))
        for i, c in enumerate(cols)
    ]
    return df.groupBy(*by).agg(*aggs).select(*by, F.inline(F.array(*items)))


def imputed(moments: DataFrame, fill: Column) -> DataFrame:
    """Mean and population deviation after filling: ``fill, mean, std`` (std 0 becomes 1)."""
    n, m, mu, var = (F.col(c) for c in ("n", "missing", "mu", "var"))
    f = fill.cast("double")
    total = (n + m).cast("double")
    mean = F.coalesce((n * mu + m * f) / total, f)
    spread = F.coalesce(n * (var + (mu - mean) * (mu - mean)), F.lit(0.0)) + m * (f - mean) * (f - mean)
    std = F.sqrt(spread / total)
    return moments.select(
        "*", f.alias("fill"), mean.alias("mean"), F.when(std > 0, std).otherwise(F.lit(1.0)).alias("std")
    )


STRATEGIES = ("mean", "median", "most_frequent", "zero")


def fill_values(df: DataFrame, strategy: dict[str, str]) -> dict[str, float | None]:
    """The fill of every numeric column whose strategy is not the mean."""
    bad = set(strategy.values()) - set(STRATEGIES)
    if bad:
        raise ValueError(f"unknown strategy: {sorted(bad)}")
    out: dict[str, float | None] = {c: 0.0 for c, s in strategy.items() if s == "zero"}
    med = [c for c, s in strategy.items() if s == "median"]
    if med:
        q = quantile_row(df, med, [0.5])
        out |= {c: q[c].get(0.5) for c in med}
    freq = [c for c, s in strategy.items() if s == "most_frequent"]
    if freq:
        items = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in freq])
        found = modes(df.select(F.inline(items)).filter("value IS NOT NULL").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))
        out |= {r["feature"]: r["mode"] for r in found.collect()}  # one row per column
    return out


def modes(counts: DataFrame, keys: Sequence[str] = ("feature",), n: str = "n") -> DataFrame:
    """Most frequent value per key from ``(keys..., value, n)``; the smallest on ties."""
    best = F.min(F.struct((-F.col(n)).alias("_k"), F.col("value"))).alias("_b")
    return counts.groupBy(*keys).agg(best).select(*keys, F.col("_b.value").alias("mode"))


def fit_numeric(df: DataFrame, cols: Sequence[str], strategy: str | dict[str, str] = "mean") -> DataFrame:
    """``(feature, n, missing, mu, var, fill, mean, std)`` of the given rows."""
    strategy = {c: (strategy if isinstance(strategy, str) else strategy[c]) for c in cols}
    fills = fill_values(df, {c: s for c, s in strategy.items() if s != "mean"})
    m = numeric_moments(df, cols)
    fill = F.col("mu")
    for c, v in fills.items():
        fill = F.when(F.col("feature") == c, F.lit(v).cast("double")).otherwise(fill)
    return imputed(m, fill)


def fold_numeric(df: DataFrame, cols: Sequence[str], fold: str = "fold") -> DataFrame:
    """Mean-imputed statistics of the training side of every fold, from one pass.

    The other folds' parts are combined with the parallel-variance identity, so
    nothing of a fold's own rows enters its statistics.
    """
    part = numeric_moments(df, cols, [fold]).filter("n + missing > 0")
    parts = F.collect_list(F.struct(F.col(fold).alias("f"), "n", "missing", "mu", "var")).alias("_parts")  # one per fold
    g = part.groupBy("feature").agg(parts)
    g = g.select("feature", F.explode("_parts.f").alias(fold), "_parts")
    g = g.withColumn("_parts", F.filter("_parts", lambda x: x["f"] != F.col(fold)))

    def total(of, start=0.0):
        return F.aggregate("_parts", F.lit(start), lambda acc, x: acc + F.coalesce(of(x), F.lit(start)))

    zero = F.lit(0).cast("bigint")
    n = F.aggregate("_parts", zero, lambda acc, x: acc + x["n"])
    missing = F.aggregate("_parts", zero, lambda acc, x: acc + x["missing"])
    g = g.withColumns({"n": n, "missing": missing})
    g = g.withColumn("mu", F.try_divide(total(lambda x: x["n"] * x["mu"]), F.col("n")))
    spread = total(lambda x: x["n"] * (x["var"] + (x["mu"] - F.col("mu")) * (x["mu"] - F.col("mu"))))
    g = g.select(fold, "feature", "n", "missing", "mu", F.try_divide(spread, F.col("n")).alias("var"))
    return imputed(g, F.col("mu"))


def scale_columns(df: DataFrame, stats: DataFrame, cols: Sequence[str], suffix: str = "_z") -> DataFrame:
    """Fill and scale with a one-row broadcast of the fitted numbers."""
    row = stats.groupBy().agg(
        *[F.max(F.when(F.col("feature") == c, F.struct("fill", "mean", "std"))).alias(f"_s{i}") for i, c in enumerate(cols)]
    )
    z = [
        ((F.coalesce(F.col(c).cast("double"), F.col(f"_s{i}.fill")) - F.col(f"_s{i}.mean")) / F.col(f"_s{i}.std")).alias(c + suffix)
        for i, c in enumerate(cols)
    ]
    return df.crossJoin(F.broadcast(row)).select(*df.columns, *z)


# ---------------------------------------------------------------- categorical


def category_counts(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., feature, value, n)`` of non-null values, all columns in one shuffle."""
    items = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols])
    long = df.select(*by, F.inline(items)).filter("value IS NOT NULL")
    return long.groupBy(*by, "feature", "value").agg(F.count(F.lit(1)).alias("n"))


def fold_categories(df: DataFrame, cols: Sequence[str], fold: str = "fold", k: int = 5) -> DataFrame:
    """``(fold, feature, value, n)``: training-side counts of every fold, from one pass."""
    c = category_counts(df, cols, [fold])
    g = c.groupBy("feature", "value").agg(
        F.sum("n").alias("_all"), F.map_from_entries(F.collect_list(F.struct(fold, "n"))).alias("_own")  # k entries
    )
    each = g.select("feature", "value", "_all", "_own", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias(fold))
    n = F.col("_all") - F.coalesce(F.try_element_at("_own", F.col(fold)), F.lit(0))
    return each.select(fold, "feature", "value", n.alias("n")).filter("n > 0")


def vocabulary(counts: DataFrame, integer: Sequence[str] = ()) -> DataFrame:
    """Class list ``(feature, value, code, n)`` in sorted order; integer features sort as numbers.

    Codes are places in the sorted order of distinct values. The rows are cut into ranges of that order, which are
    numbered by running counts; nothing but the sizes of ranges is added up across them.
    """
    counts = settle(counts.select("feature", "value", "n"), "vocabulary")
    number = F.when(F.col("feature").isin(list(integer)), F.col("value").try_cast("bigint")) if integer else F.lit(None).cast("bigint")
    rows = counts.withColumn("_num", number).withColumn("_one", F.lit(1))
    n_buckets = bucket_target(counts.sparkSession, counts.count())
    cut = rows.repartitionByRange(n_buckets, "feature", "_num", "value").withColumn("_at", F.spark_partition_id())
    place = F.struct("_num", "value")
    out = rank.cumulate(settle(cut.withColumn("_place", place), "ranges"), ["feature"], "_place", "_at", ["_one"])
    return out.select("feature", "value", (F.col("cum__one") - 1).cast("int").alias("code"), "n")


UNKNOWN_MODES = ("zeros", "train_mode", "batch_mode")


def encode_long(df: DataFrame, key: str, cols: Sequence[str], vocab: DataFrame, unknown: str = "zeros") -> DataFrame:
    """One row per (key, feature): the value after unknown handling and its code.

    ``code`` is NULL for an all-zero block. Known values are found by a join on
    (feature, value), so a vocabulary of any size works.
    """
    if unknown not in UNKNOWN_MODES:
        raise ValueError(f"unknown must be one of {UNKNOWN_MODES}")
    items = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols])
    long = df.select(F.col(key), F.inline(items))
    known = vocab.select("feature", "value", F.col("code").alias("_code"))
    sized = known.join(category_counts(df, cols), ["feature", "value"], "left").withColumnRenamed("n", "_n")
    out = lookup(long, sized.fillna({"_n": 0}), ["feature", "value"], "_n", key)
    if unknown == "zeros":
        return out.select(key, "feature", "value", F.col("_code").alias("code"))
    source = vocab if unknown == "train_mode" else category_counts(df, cols)
    repl = modes(source)
    repl = repl.join(known.select("feature", F.col("value").alias("mode"), F.col("_code").alias("_mode_code")), ["feature", "mode"], "left")
    out = out.join(F.broadcast(repl), "feature", "left")  # one row per feature
    first = vocab.filter("code = 0").select("feature", F.col("value").alias("_first"))
    out = out.join(F.broadcast(first), "feature", "left")
    value = F.coalesce(F.when(F.col("_code").isNotNull(), F.col("value")), F.col("mode"), F.col("_first"))
    code = F.coalesce("_code", F.when(F.col("mode").isNull(), F.lit(0)).otherwise(F.col("_mode_code")))
    return out.select(key, "feature", value.alias("value"), code.alias("code"))


def unknown_counts(df: DataFrame, cols: Sequence[str], vocab: DataFrame) -> DataFrame:
    """How many rows per feature hold a value outside the vocabulary (NULL included)."""
    items = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols])
    n = df.select(F.inline(items)).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("_n"))  # collapsed first
    known = n.join(vocab.select("feature", "value", "code"), ["feature", "value"], "left")
    return known.groupBy("feature").agg(
        F.coalesce(F.sum(F.when(F.col("code").isNull(), F.col("_n"))), F.lit(0)).alias("unknown")
    )


def target_encoding(df: DataFrame, cols: Sequence[str], target: str, fold: str | None = None, k: int = 5) -> DataFrame:
    """Target mean per category; with ``fold`` over the other folds only.

    ``(fold, feature, value, n, encoded)``; a category not seen in training has
    no row and takes the prior of :func:`target_prior`.
    """
    by = [fold] if fold else []
    items = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols])
    long = df.select(*by, F.col(target).cast("double").alias("_y"), F.inline(items)).filter("value IS NOT NULL")
    g = long.groupBy(*by, "feature", "value").agg(F.count("_y").alias("n"), F.sum("_y").alias("s"))
    if fold:
        tot = g.groupBy("feature", "value").agg(
            F.sum("n").alias("_n"), F.sum("s").alias("_s"),
            F.map_from_entries(F.collect_list(F.struct(F.col(fold), F.struct("n", "s")))).alias("_own"),
        )
        each = tot.select("*", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias(fold))
        own = F.try_element_at("_own", F.col(fold))
        g = each.select(
            fold, "feature", "value",
            (F.col("_n") - F.coalesce(own["n"], F.lit(0))).alias("n"),
            (F.col("_s") - F.coalesce(own["s"], F.lit(0.0))).alias("s"),
        )
    return g.filter("n > 0").select(*by, "feature", "value", "n", (F.col("s") / F.col("n")).alias("encoded"))


def target_prior(df: DataFrame, target: str, fold: str | None = None) -> DataFrame:
    if not fold:
        return df.agg(F.avg(F.col(target).cast("double")).alias("prior"))
    g = df.groupBy(fold).agg(F.count(target).alias("n"), F.sum(F.col(target).cast("double")).alias("s"))
    w = Window.partitionBy()  # one row per fold
    return g.select(fold, ((F.sum("s").over(w) - F.col("s")) / (F.sum("n").over(w) - F.col("n"))).alias("prior"))


# --------------------------------------------------------------------- target


def target_column(df: DataFrame, target: str, null: str = "raise", out: str = "label") -> DataFrame:
    """Binary integer label. ``raise`` and ``drop`` refuse or leave out NULL, ``zero`` makes it 0.

    A value other than 0 or 1 always fails, when the row is read.
    """
    t = F.col(target)
    msg = F.lit(BAD_TARGET)
    if null not in ("raise", "drop", "zero"):
        raise ValueError("null must be 'raise', 'drop' or 'zero'")
    if null == "drop":
        df = df.filter(t.isNotNull())
    ok = F.when(t.isin(0, 1), t.cast("int"))
    missing = F.lit(0) if null == "zero" else F.raise_error(F.lit("Target has missing values")).cast("int")
    label = F.when(t.isNull(), missing).otherwise(F.coalesce(ok, F.raise_error(msg).cast("int")))
    return df.withColumn(out, label)


# Fixed value: how a target outside 0 and 1 is worded.
BAD_TARGET = "Target must contain only 0 and 1 values"


def check_target(df: DataFrame, target: str) -> None:
    """Fail now rather than when the rows are read."""
    if df.agg(F.count_if(~F.col(target).isin(0, 1))).first()[0]:
        raise ValueError(BAD_TARGET)


# ------------------------------------------------------------ fitted pipelines

POLICY_STRATEGY = {"impute_median": "median", "impute_mode": "most_frequent", "impute_zero": "zero"}


@dataclass
class Preprocessing:
    """A fitted plan: numbers per scaled feature, and a written table of the classes of all others.

    ``table`` holds code, count and target mean of every class; the driver knows per feature only how many
    classes there are, the most frequent one, and the mean that stands for unknown ones. ``stages`` is an ordinary
    saved-and-loaded Spark ML pipeline model that ends in a sparse ``features`` vector.
    """

    plan: dict[str, str]
    numeric: dict[str, tuple[float, float, float]]
    #: classes of each one-hot feature
    sizes: dict[str, int]
    #: most frequent class of a one-hot feature, and its code
    mode: dict[str, tuple[str, int]]
    hashed: list[str] = field(default_factory=list)
    unknown: str = "train_mode"
    hash_size: int = 4096
    #: classes of each target-encoded feature, and the mean over all training rows
    encoded: dict[str, tuple[int, float | None]] = field(default_factory=dict)
    #: bytes of each feature's classes
    weight: dict[str, int] = field(default_factory=dict)
    path: str = ""
    part: str = ""
    stages: PipelineModel | None = None

    @property
    def table(self) -> DataFrame:
        """``(feature, value, code, n, mean)`` of all classes."""
        return ClassTable(path=self.path, part=self.part).table()

    def transform(self, df: DataFrame) -> DataFrame:
        if self.stages is None:
            raise ValueError("transform needs a fitted plan")
        return self.stages.transform(df)

    def info(self) -> list[tuple[str, str, int | None]]:
        """``(feature, action, vocabulary size)`` in plan order; no size for scaled features."""
        out = []
        for c, a in self.plan.items():
            if c in self.encoded:
                out.append((c, a, self.encoded[c][0]))
            elif c in self.numeric or c in self.sizes or c in self.hashed:
                out.append((c, a, self.sizes.get(c)))
        return out

    @property
    def width(self) -> int:
        """A feature without any value keeps a block of one place."""
        n = len(self.numeric) + len(self.encoded) + sum(max(1, v) for v in self.sizes.values())
        return n + (self.hash_size if self.hashed else 0)


def _num(v: float) -> str:
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def build_stages(p: Preprocessing, spark) -> Preprocessing:
    """Turn fitted numbers and the class table into pipeline stages; reads no table."""
    if not (p.numeric or p.sizes or p.hashed or p.encoded):
        raise ValueError("the plan uses no feature")
    stages, exprs = [], []
    for c, (fill, mean, std) in p.numeric.items():
        exprs.append(f"(COALESCE(CAST(`{c}` AS DOUBLE), {_num(fill)}) - {_num(mean)}) / {_num(std)} AS `{c}__z`")
    enc, mean = list(p.sizes), list(p.encoded)
    exprs += [f"CAST(`{c}` AS STRING) AS `{c}__s`" for c in (*enc, *mean)]
    exprs += [f"COALESCE(CAST(`{c}` AS STRING), '') AS `{c}__h`" for c in p.hashed]
    stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__"))
    blocks = {c: f"{c}__z" for c in p.numeric} | {c: f"{c}__t" for c in mean} | {c: f"{c}__v" for c in enc}
    layout = {}
    for c in mean:
        layout[c] = {"kind": "mean", "other": p.encoded[c][1], "classes": p.encoded[c][0], "bytes": p.weight.get(c, 0)}
    for c in enc:
        width = max(1, p.sizes[c])
        # the place after the last class is a block of zeros
        other = p.mode[c][1] if p.unknown == "train_mode" and c in p.mode else width
        layout[c] = {"kind": "code", "other": other, "classes": p.sizes[c], "bytes": p.weight.get(c, 0)}
    if layout:
        stages.append(ClassTable(layout=json.dumps(layout), path=p.path, part=p.part))
    if enc:
        # the encoder needs only the class counts, given as one row of top codes
        top = spark.createDataFrame([tuple(float(max(1, p.sizes[c])) for c in enc)], [f"{c}__j" for c in enc])
        hot = OneHotEncoder(
            inputCols=[f"{c}__j" for c in enc], outputCols=[f"{c}__v" for c in enc], dropLast=True
        ).fit(top)
        stages.append(hot)
    inputs = [blocks[c] for c in p.plan if c in blocks]
    if p.hashed:
        stages.append(FeatureHasher(inputCols=[f"{c}__h" for c in p.hashed], outputCol="hashed__v", numFeatures=p.hash_size))
        inputs.append("hashed__v")
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error"))
    made = [f"{c}__z" for c in p.numeric] + [f"{c}__{x}" for c in mean for x in "st"] + [f"{c}__h" for c in p.hashed] + (["hashed__v"] if p.hashed else [])
    for c in enc:
        made += [f"{c}__{s}" for s in "sjv"]
    keep = f"SELECT * EXCEPT ({', '.join(f'`{m}`' for m in made)}) FROM __THIS__"
    stages.append(SQLTransformer(statement=keep))
    p.stages = PipelineModel(stages)
    return p


def _columns(plan: dict[str, str], target: str) -> tuple[list[str], list[str], list[str], list[str]]:
    """Features to scale, to one-hot, to encode by target mean and to hash."""

    def of(*actions):
        return [c for c, a in plan.items() if a in actions and c != target]

    return of("scale"), of("onehot", "embed"), of("target_encode"), of("hash")


def _integers(df: DataFrame, cols: Sequence[str]) -> set[str]:
    kinds = dict(df.dtypes)
    return {c for c in cols if kinds[c] in ("tinyint", "smallint", "int", "bigint")}


def _write_classes(codes: DataFrame | None, means: DataFrame | None, spark, by: Sequence[str] = ()) -> tuple[str, list]:
    """Write the class table, sorted by feature and value, and sum it up per feature: classes, bytes, most frequent class."""
    none_int, none_float = F.lit(None).cast("int").alias("code"), F.lit(None).cast("double").alias("mean")
    parts = []
    if codes is not None:
        parts.append(codes.select(*by, "feature", "value", "code", "n", none_float))
    if means is not None:
        parts.append(means.select(*by, "feature", "value", none_int, "n", F.col("encoded").alias("mean")))
    if not parts:
        return "", []
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    path = scratch(spark, "classes")
    rows.repartitionByRange(*by, "feature", "value").sortWithinPartitions(*by, "feature", "value").write.partitionBy(*by).parquet(path)
    best = F.min(F.struct((-F.col("n")).alias("k"), "value", "code")).alias("best")
    weight = F.sum(F.octet_length("value")).alias("bytes")
    return path, spark.read.parquet(path).groupBy(*by, "feature").agg(F.count(F.lit(1)).alias("classes"), weight, best).collect()


def _with_classes(p: Preprocessing, found: list, encode: Sequence[str], means: Sequence[str], prior: float | None) -> Preprocessing:
    by = {r["feature"]: r for r in found}
    p.sizes = {c: by[c]["classes"] if c in by else 0 for c in encode}
    p.mode = {c: (by[c]["best"]["value"], by[c]["best"]["code"]) for c in encode if c in by}
    p.encoded = {c: (by[c]["classes"] if c in by else 0, prior) for c in means}
    p.weight = {c: r["bytes"] for c, r in by.items()}
    return p


def fit_preprocessing(
    train: DataFrame,
    plan: dict[str, str],
    target: str,
    policy: str = "mean",
    contract: Contract | None = None,
    unknown: str = "train_mode",
    hash_size: int = 4096,
) -> Preprocessing:
    """Fit the plan on training rows only.

    ``policy="contract"`` imputes as the contract declares instead of by the
    mean. Every action does what it says at any number of classes: classes are rows of a written table. A one-hot block has one
    place per class, and so does a model over it; the action
    ``hash`` is there for features with more classes than that is wanted for. A feature
    without any value keeps a block of one place that is always zero.
    """
    if unknown not in ("zeros", "train_mode"):
        raise ValueError("a fitted pipeline takes unknown='zeros' or 'train_mode'")
    scale, encode, means, hashed = _columns(plan, target)
    select_features(train, [*scale, *encode, *means, *hashed])
    check_target(train, target)
    strategy = {c: "mean" for c in scale}
    if policy == "contract":
        if contract is None:
            raise ValueError("policy='contract' needs a contract")
        strategy = {c: POLICY_STRATEGY.get(contract.policy(c), "mean") for c in scale}
    elif policy != "mean":
        raise ValueError("policy must be 'mean' or 'contract'")
    numeric = {}
    if scale:
        for r in fit_numeric(train, scale, strategy).collect():  # one row per column
            numeric[r["feature"]] = (r["fill"] or 0.0, r["mean"] or 0.0, r["std"])
    codes = vocabulary(category_counts(train, encode), sorted(_integers(train, encode))) if encode else None
    prior = target_prior(train, target).first()[0] if means else None
    path, found = _write_classes(codes, target_encoding(train, means, target) if means else None, train.sparkSession)
    p = Preprocessing(plan, {c: numeric[c] for c in scale}, {}, {}, hashed, unknown, hash_size, path=path)
    return build_stages(_with_classes(p, found, encode, means, prior), train.sparkSession)


def fold_vocabulary(counts: DataFrame, integer: Sequence[str] = (), fold: str = "fold", k: int = 5) -> DataFrame:
    """``vocabulary`` of each fold from ``(fold, feature, value, n)``, in one pass."""
    name = lambda f: F.concat(F.col(f).cast("string"), F.lit("\n"), F.col("feature"))
    ints = [f"{i}\n{c}" for c in integer for i in range(k)]
    both = F.split("feature", "\n", 2)
    out = vocabulary(counts.withColumn("feature", name(fold)), ints)
    return out.select(both[0].cast("int").alias(fold), both[1].alias("feature"), "value", "code", "n")


def fit_folds(
    df: DataFrame,
    plan: dict[str, str],
    target: str,
    k: int,
    fold: str = "fold",
    unknown: str = "train_mode",
    hash_size: int = 4096,
) -> list[Preprocessing]:
    """Fold-safe pipelines for all folds from one numeric and one categorical pass.

    The classes of all folds are one table, partitioned by fold.
    """
    scale, encode, means, hashed = _columns(plan, target)
    select_features(df, [*scale, *encode, *means, *hashed])
    check_target(df, target)
    spark = df.sparkSession
    numeric: list[dict] = [{} for _ in range(k)]
    if scale:
        for r in fold_numeric(df, scale, fold).collect():  # folds x columns
            numeric[r[fold]][r["feature"]] = (r["fill"] or 0.0, r["mean"] or 0.0, r["std"])
    codes = fold_vocabulary(fold_categories(df, encode, fold, k), sorted(_integers(df, encode)), fold, k) if encode else None
    encoded = target_encoding(df, means, target, fold, k) if means else None
    path, found = _write_classes(codes, encoded, spark, [fold])
    prior = {r[fold]: r["prior"] for r in target_prior(df, target, fold).collect()} if means else {}
    out = []
    for i in range(k):
        p = Preprocessing(plan, {c: numeric[i][c] for c in scale}, {}, {}, hashed, unknown, hash_size, path=path, part=f"`{fold}` = {i}")
        out.append(build_stages(_with_classes(p, [r for r in found if r[fold] == i], encode, means, prior.get(i)), spark))
    return out
