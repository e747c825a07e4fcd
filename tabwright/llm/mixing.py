"""Mixing sources to target weights by iterative proportional fitting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.base import text_of
from tabwright.operators.joins import lookup
from tabwright.session import settle

#: What carries no target of its own.
OTHER = "(other)"
#: Values of a marginal that a table on the driver may have; with more, the cells are raked as a DataFrame.
MAX_VALUES = 2_000
#: Rounds of such raking, and the error of a share at which it ends.
ROUNDS, TOLERANCE = 50, 1e-6


def topic_of(text: Column) -> Column:
    """A coarse topic by form: empty, license, noise, list, note, prose or long."""
    n = F.length(text)
    return (
        F.when(F.trim(text) == "", "empty")
        .when(F.lower(text).rlike("licen[sc]e|copyright"), "license")
        .when(text.rlike("[*#$%&]{3}"), "noise")
        .when(n < 600, "note")
        .when(n >= 8_000, "long")
        .otherwise("prose")
    )


def n_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("bigint")


def tempered(mass: Mapping[str, float], power: float) -> dict[str, float]:
    """Targets proportional to a power of the observed masses; below 1 this lifts the small ones."""
    up = {k: float(v) ** power for k, v in mass.items() if v > 0}
    return {k: v / sum(up.values()) for k, v in up.items()}


def fit(
    mass: np.ndarray, targets: Sequence[np.ndarray], cap: np.ndarray | None = None, rounds: int = 2000, tol: float = 1e-10
) -> np.ndarray:
    """Rake a table of masses until its marginals have the target shares, no cell above its ``cap``.

    A target of a value without mass is spread over the others. What a full cell cannot
    give, the other cells of its row and column give. Where the targets contradict each other
    or the caps, the last round's table is the answer.
    """
    table = mass / mass.sum()
    goals = []
    for axis, goal in enumerate(targets):
        there = table.sum(axis=tuple(i for i in range(table.ndim) if i != axis)) > 0
        goal = np.where(there, goal, 0.0)
        goals.append(goal / goal.sum() if goal.sum() else there / there.sum())
    for _ in range(rounds):
        worst = 0.0
        for axis, goal in enumerate(goals):
            others = tuple(i for i in range(table.ndim) if i != axis)
            now = table.sum(axis=others)
            worst = max(worst, float(np.abs(now - goal).max()))
            step = np.divide(goal, now, out=np.zeros_like(goal), where=now > 0)
            table = table * np.expand_dims(step, others)
        if cap is not None:
            table = np.minimum(table, cap)
        if worst < tol:
            break
    return table


def _wanted(goal: Mapping[str, float], values: Sequence[str], rest: float) -> np.ndarray:
    """Target shares of ``values`` and of all others, which had the share ``rest``.

    What the named ones leave to 1 is for the others. If they leave nothing, the others keep their share.
    """
    named = np.array([goal[v] for v in values])
    left = 1.0 - named.sum()
    return np.array([*named, left]) if left > 1e-9 or not len(named) else np.array([*(named * (1 - rest) / named.sum()), rest])


def _rake(cells: DataFrame, large: Mapping[str, float], small: Mapping[str, Mapping[str, float]], share: float) -> DataFrame:
    """``cells`` (keys, m, n) with weight and probability, as ``fit`` gives them, without collecting them.

    ``large`` has the power of each marginal of many values, ``small`` the goals of the others by value. A round scales each large
    marginal by a join, and the small ones by factors found from their summed table; it is written before the next.
    """
    total = float(cells.agg(F.sum("m")).first()[0])
    table = settle(cells.withColumn("o", F.col("m") / total).withColumn("t", F.col("m") / total), "cells")
    goals = {}
    for k, power in large.items():
        up = table.groupBy(k).agg(F.pow(F.sum("m"), F.lit(power)).alias("goal"))
        whole = float(up.agg(F.sum("goal")).first()[0])
        goals[k] = settle(up.select(k, (F.col("goal") / whole).alias("goal")), "goals")
    axes = list(small)
    for _ in range(ROUNDS):
        worst, now = 0.0, table
        for k, goal in goals.items():
            sums = settle(now.groupBy(k).agg(F.sum("t").alias("s")).join(goal, k), "sums")
            worst = max(worst, float(sums.agg(F.max(F.abs(F.col("s") - F.col("goal")))).first()[0] or 0.0))
            step = F.when(F.col("s") > 0, F.col("goal") / F.col("s")).otherwise(0.0).alias("step")
            now = now.join(sums.select(k, step), k).withColumn("t", F.col("t") * F.col("step")).drop("step")
        if axes:
            seen = now.groupBy(*axes).agg(F.sum("t").alias("t")).collect()
            part = np.array([float(r["t"]) for r in seen])
            before = part.copy()
            for a in axes:
                codes = np.array([r[a] for r in seen])
                there = {v: small[a].get(v, 0.0) for v in set(codes.tolist())}
                whole = sum(there.values())
                for v, g in there.items():
                    g = g / whole if whole else 1 / len(there)
                    s = part[codes == v].sum()
                    worst = max(worst, abs(s - g))
                    part[codes == v] *= g / s if s > 0 else 0.0
            factors = np.divide(part, before, out=np.zeros_like(part), where=before > 0)
            steps = cells.sparkSession.createDataFrame([(*(r[a] for a in axes), float(f)) for r, f in zip(seen, factors, strict=True)], ", ".join([*(f"{a} string" for a in axes), "step double"]))
            now = now.join(F.broadcast(steps), axes).withColumn("t", F.col("t") * F.col("step")).drop("step")
        table = settle(now.withColumn("t", F.least("t", F.col("o") / share)), "cells")
        if worst < TOLERANCE:
            break
    ratio = F.col("t") / F.col("o")
    return table.select(*large, *axes, "n", ratio.alias("weight"), F.least(F.lit(1.0), ratio * share).alias("probability"))


def mix(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str, float] | float],
    share: float = 0.5,
    seed: int = 1,
    tokens: Column | None = None,
) -> DataFrame:
    """``docs`` with ``n_tokens``, ``weight``, ``probability`` and ``kept``.

    ``targets`` has, for each column that makes a marginal, either target shares by value
    (values not named together form one more, whose target is what is left to 1; if nothing is left, it keeps its
    observed share and the named ones divide the rest) or a power of the observed token masses. Cell masses come from one
    grouped aggregation; only values with a target have cells of their own. A marginal of more than MAX_VALUES values is
    raked as a DataFrame, to TOLERANCE or for ROUNDS rounds.
    ``weight`` is the fitted share of a cell over its observed share, as large as rows last: a cell
    cannot give more than it has. A row is kept with ``probability`` = ``share`` of all tokens
    times that weight, by a number drawn from its id.

    A null value of a marginal is a value of its own, as text '(null)'. Rows without
    tokens have no mass and get their cell's probability, or ``share`` if it has none.
    Input columns of the four names are replaced. Rows with the same id are kept
    or dropped together. An empty table stays empty.
    """
    names = list(targets)
    docs = docs.drop("n_tokens", "weight", "probability", "kept")
    text = text_of() if "text" in docs.columns else F.lit("")
    rows = docs.withColumn("n_tokens", n_tokens(text) if tokens is None else tokens)
    label = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("(null)"))
    # the one pass over the texts that the fit needs
    masses = rows.groupBy(*[label(c).alias(c) for c in names]).agg(F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n"))
    masses = settle(masses, "masses")
    goals: dict[str, dict[str, float]] = {}
    large: dict[str, float] = {}
    for c in names:
        goal = targets[c]
        if not isinstance(goal, Mapping):
            seen = masses.groupBy(label(c).alias("v")).agg(F.sum("n_tokens").alias("m")).orderBy(F.desc("m"), "v").limit(MAX_VALUES + 1).collect()
            if len(seen) > MAX_VALUES:
                large[c] = float(goal)
                continue
            goal = tempered({r["v"]: r["m"] for r in seen}, float(goal))
        goals[c] = dict(goal)
    values = {c: [*sorted(goals[c]), OTHER] for c in goals}
    cell = {c: label(c) if c in large else F.when(label(c).isin(values[c][:-1]), label(c)).otherwise(F.lit(OTHER)) if goals[c] else F.lit(OTHER) for c in names}
    cells_of = {f"_{i}": cell[c] for i, c in enumerate(names)}
    rows, keys = rows.withColumns(cells_of), list(cells_of)
    draw = F.xxhash64(F.lit(seed), F.col("doc_id").cast("string")) / 2.0**64 + 0.5
    grouped = masses.withColumns(cells_of).groupBy(*keys).agg(F.sum("n_tokens").alias("m"), F.sum("n").alias("n")).filter("m > 0")
    if large:
        grouped = settle(grouped, "cells")
        key = {c: f"_{i}" for i, c in enumerate(names)}
        whole, small = float(grouped.agg(F.sum("m")).first()[0]), {}
        for c in goals:
            rest = float(grouped.filter(F.col(key[c]) == OTHER).agg(F.sum("m")).first()[0] or 0.0) / whole
            small[key[c]] = dict(zip(values[c], _wanted(goals[c], values[c][:-1], rest).tolist(), strict=True))
        table = settle(_rake(grouped, {key[c]: p for c, p in large.items()}, small, share), "raked")
        rows = lookup(rows, table, keys, "n", "doc_id").drop(*keys).fillna({"weight": 1.0, "probability": share})
        return rows.withColumn("kept", draw < F.col("probability"))
    got = grouped.collect()
    mass = np.zeros([len(values[c]) for c in names])
    place = [{v: i for i, v in enumerate(values[c])} for c in names]
    for r in got:
        mass[tuple(p[r[k]] for p, k in zip(place, keys, strict=True))] = r["m"]
    spark = docs.sparkSession
    cells = []
    if got:
        observed = mass / mass.sum()
        rest = [float(np.moveaxis(observed, i, 0)[-1].sum()) for i in range(len(names))]
        want = [_wanted(goals[c], values[c][:-1], r) for c, r in zip(names, rest, strict=True)]
        ratio = np.divide(fit(mass, want, observed / share), observed, out=np.zeros_like(mass), where=mass > 0)
        p = np.minimum(1.0, share * ratio)
        for at in np.argwhere(mass > 0):
            i = tuple(at)
            cells.append((*(values[c][j] for c, j in zip(names, i, strict=True)), float(ratio[i]), float(p[i])))
    table = spark.createDataFrame(cells, ", ".join([*(f"{k} string" for k in keys), "weight double", "probability double"]))
    rows = rows.join(F.broadcast(table), keys, "left").drop(*keys)
    rows = rows.fillna({"weight": 1.0, "probability": share})
    return rows.withColumn("kept", draw < F.col("probability"))
