"""Global order without a single-task window.

Curves, exact quantiles, drift statistics and splits all need a position in one
order over all rows. A window without keys would put every row in one task, so:

* values are first collapsed (one row per distinct value, map-side combined), so
  that a value holding a third of the rows becomes one row;
* the collapsed table is written once, which also tells how many buckets it needs;
* each value gets a range bucket, running sums are taken per bucket,
  and the few per-bucket totals are turned into offsets that are joined back.

Bucket edges come from a quantile sketch. They decide balance only, never the
result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.scalar import number
from tabwright.session import bucket_target, settle

BUCKET = "_bucket"


def range_splits(df: DataFrame, cols: Sequence[str], n: int | None = None) -> dict[str, list[float]]:
    """Bucket edges per column from one sketch pass over just those columns."""
    n = n or bucket_target(df.sparkSession)
    probs = [i / n for i in range(1, n)]
    found = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).approxQuantile(
        list(cols), probs, 0.5 / n
    )
    out = {}
    for c, qs in zip(cols, found):
        inner = sorted(set(qs))
        out[c] = [float("-inf"), *inner, float("inf")] if inner else [float("-inf"), 0.0, float("inf")]
    return out


def with_buckets(df: DataFrame, splits: dict[str, list[float]], suffix: str = BUCKET) -> DataFrame:
    """Add ``<col><suffix>`` holding the range bucket of each column."""
    cols = list(splits)
    cut = Bucketizer(
        splitsArray=[splits[c] for c in cols],
        inputCols=cols,
        outputCols=[c + suffix for c in cols],
        handleInvalid="keep",
    ).transform(df)
    return cut.withColumns({c + suffix: F.col(c + suffix).cast("int") for c in cols})


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    cond = None
    for k in keys:
        one = left[k].eqNullSafe(right["_r_" + k])
        cond = one if cond is None else cond & one
    return cond


def cumulate(
    counts: DataFrame,
    by: Sequence[str],
    order: str,
    bucket: str,
    measures: Sequence[str],
    descending: bool = False,
    peek: bool = False,
) -> DataFrame:
    """Global running sums over a collapsed table (one row per ``by``, ``order``).

    Adds ``cum_<m>`` (inclusive) and ``tot_<m>`` for every measure, and with
    ``peek`` also ``next_<m>``: the measure of the next row in the global order.
    """
    turn = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    keys = [*by, bucket]
    inside = Window.partitionBy(*keys).orderBy(turn(order))
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    rows = counts.select(
        "*",
        *[F.sum(m).over(running).alias("_in_" + m) for m in measures],
        *([F.lead(m).over(inside).alias("_ld_" + m) for m in measures] if peek else []),
    )
    first = F.max_by if descending else F.min_by
    per_bucket = counts.groupBy(*keys).agg(
        *[F.sum(m).alias("_t_" + m) for m in measures],
        *([first(m, order).alias("_f_" + m) for m in measures] if peek else []),
    )
    # at most (groups x buckets) rows from here on
    across = Window.partitionBy(*by).orderBy(turn(bucket))
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *[F.col(k).alias("_r_" + k) for k in keys],
        *[F.coalesce(F.sum("_t_" + m).over(before), F.lit(0)).alias("_o_" + m) for m in measures],
        *[F.sum("_t_" + m).over(Window.partitionBy(*by)).alias("tot_" + m) for m in measures],
        *([F.lead("_f_" + m).over(across).alias("_nf_" + m) for m in measures] if peek else []),
    )
    joined = rows.join(offsets, same_keys(rows, offsets, keys))
    return joined.select(
        *counts.columns,
        *[(F.col("_in_" + m) + F.col("_o_" + m)).alias("cum_" + m) for m in measures],
        *[F.col("tot_" + m) for m in measures],
        *(
            [F.coalesce("_ld_" + m, "_nf_" + m).alias("next_" + m) for m in measures]
            if peek
            else []
        ),
    )


def ordered(
    counts: DataFrame,
    by: Sequence[str],
    order: str,
    measures: Sequence[str],
    descending: bool = False,
    peek: bool = False,
) -> DataFrame:
    """Write a collapsed table once and add its running sums, see :func:`cumulate`."""
    counts = settle(counts, "counts")
    splits = range_splits(counts, [order], bucket_target(counts.sparkSession, counts.count()))
    cut = with_buckets(counts, splits)
    return cumulate(cut, by, order, order + BUCKET, measures, descending, peek).drop(order + BUCKET)


def long_values(df: DataFrame, cols: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """One row per (column, numeric value that is neither NULL nor NaN); no shuffle. -0.0 is 0.0."""
    items = [F.struct(F.lit(c).alias("column"), number(c).alias("value")) for c in cols]
    return df.select(*extra, F.inline(F.array(*items))).filter(F.col("value").isNotNull())


#: Share of the rows by which a sketched place may be off.
SKETCH_ERROR = 1e-3


def brackets(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[tuple[str, float], tuple[float, float]]:
    """Values between which the quantiles of many rows lie, from one mergeable sketch per column; no entry without values."""
    wide = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-2 * SKETCH_ERROR, 2 * SKETCH_ERROR)})
    found = df.select(*[number(c).alias(f"c{i}") for i, c in enumerate(cols)]).approxQuantile([f"c{i}" for i in range(len(cols))], wide, SKETCH_ERROR)
    out = {}
    for c, values in zip(cols, found, strict=True):
        at = dict(zip(wide, values, strict=False))
        for p in probs if values else ():
            out[c, p] = at[max(0.0, p - 2 * SKETCH_ERROR)], at[min(1.0, p + 2 * SKETCH_ERROR)]
    return out


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation: ``(column, prob, value, n)``.

    A sketch gives two values around each wanted place. One pass counts the rows below and up to each bracket; those inside, some
    4 * SKETCH_ERROR of all, are collapsed and brought into order, and only the rows at the wanted places go on. The whole is never
    sorted. Of few rows that share is less than the two rows to interpolate between: where the counts show that a bracket
    lacks one, all values are taken. NaN counts as missing; a column without values gives no row.
    """
    probs = [float(p) for p in probs]
    near = brackets(df, cols, probs)
    spark = df.sparkSession
    if not near:
        return spark.createDataFrame([], '"column" string, prob double, value double, n bigint'.replace('"', "`"))
    values = df.select(*[number(c).alias(f"c{i}") for i, c in enumerate(cols)])
    place = {c: i for i, c in enumerate(cols)}
    sums = [F.count(f"c{i}").alias(f"n{i}") for i in range(len(cols))]
    keys = list(near)
    sums += [F.count_if(F.col(f"c{place[c]}") < near[c, p][0]).alias(f"b{k}") for k, (c, p) in enumerate(keys)]
    sums += [F.count_if(F.col(f"c{place[c]}") <= near[c, p][1]).alias(f"u{k}") for k, (c, p) in enumerate(keys)]
    known = values.agg(*sums).first().asDict()
    for k, (c, p) in enumerate(keys):
        pos = (known[f"n{place[c]}"] - 1) * p
        if not known[f"b{k}"] <= math.floor(pos) <= math.ceil(pos) < known[f"u{k}"]:
            near[c, p], known[f"b{k}"] = (-math.inf, math.inf), 0
    inside = [F.struct(F.lit(k).alias("k"), F.col(f"c{place[c]}").alias("value")) for k, (c, p) in enumerate(keys)]
    held = [F.when(F.col(f"c{place[c]}").between(*near[c, p]), inside[k]) for k, (c, p) in enumerate(keys)]
    rows = values.select(F.inline(F.filter(F.array(*held), lambda x: x.isNotNull())))
    counts = rows.groupBy("k", "value").agg(F.count(F.lit(1)).alias("m"))
    # one row per column and place
    asked = [(k, c, p, known[f"n{place[c]}"], known[f"b{k}"]) for k, (c, p) in enumerate(keys)]
    asked = F.broadcast(spark.createDataFrame(asked, "k int, column string, prob double, n bigint, below bigint"))
    c = ordered(counts, ["k"], "value", ["m"]).join(asked, "k")
    pos = (F.col("n") - 1) * F.col("prob")
    first, last = F.col("below") + F.col("cum_m") - F.col("m"), F.col("below") + F.col("cum_m") - 1
    left, right = F.floor(pos).between(first, last), F.ceil(pos).between(first, last)
    at = c.filter(left | right).groupBy("column", "prob", "n").agg(F.max(F.when(left, F.col("value"))).alias("a"), F.max(F.when(right, F.col("value"))).alias("b"))
    return at.select("column", "prob", (F.col("a") + (F.col("b") - F.col("a")) * (pos - F.floor(pos))).alias("value"), "n")


def quantile_row(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, dict[float, float]]:
    """Exact quantiles as a small driver dict (columns x probs numbers)."""
    out: dict[str, dict[float, float]] = {c: {} for c in cols}
    for r in exact_quantiles(df, cols, probs).collect():
        out[r["column"]][r["prob"]] = r["value"]
    return out


DIGEST_WIDTH = 32
PREFIX_STEP = 4


def digest_cuts(df: DataFrame, digest: str, places: Callable[[dict], dict], by: str | None = None) -> dict[object, list[str]]:
    """The digests found at given places of each group's digest order.

    ``places`` gets the row count per group and returns the wanted 0-based places
    per group, in rising order. Rows are counted per digest prefix, then only the
    prefixes that hold a place are counted again with a longer prefix, until each holds
    one digest only. Every round is one scan of the key; the driver sees at most
    16**4 counts per place, and rows of a repeated key count as one
    digest. Places past the end give no digest.
    """
    src = df.select((F.col(by) if by else F.lit(0)).alias("_g"), F.col(digest).alias("_h"))

    def sizes(rows: DataFrame, width: int) -> dict:
        seen = [F.count(F.lit(1)).alias("n"), F.min("_h").alias("a"), F.max("_h").alias("b")]
        got = rows.groupBy("_g", F.substring("_h", 1, width).alias("_p")).agg(*seen).collect()
        out: dict = {}
        for r in got:
            out.setdefault(r["_g"], []).append((r["_p"], r["n"], r["a"] if r["a"] == r["b"] else None))
        return {g: sorted(v, key=lambda x: x[0]) for g, v in out.items()}

    width = PREFIX_STEP
    level = sizes(src, width)
    totals = {g: sum(x[1] for x in v) for g, v in level.items()}
    cuts = [(g, pos, "", 0) for g, wanted in places(totals).items() for pos in wanted if pos < totals.get(g, 0)]
    found: dict = {}
    while cuts:
        near = []
        for g, pos, start, before in cuts:
            for prefix, n, only in level.get(g, []):
                if not prefix.startswith(start):
                    continue
                if pos < before + n:
                    if only is None:
                        near.append((g, pos, prefix, before))
                    else:
                        found[g, pos] = only
                    break
                before += n
        cuts = near
        if cuts:
            rows = src.filter(F.substring("_h", 1, width).isin(sorted({c[2] for c in cuts})))
            width = min(DIGEST_WIDTH, width + PREFIX_STEP)
            level = sizes(rows, width)
    out: dict = {g: [] for g in totals}
    for g, pos in sorted(found, key=lambda x: x[1]):
        out[g].append(found[g, pos])
    return out
