"""Quality of documents: a kernel ridge fit by random Fourier features over text statistics, calibrated by isotonic regression."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.base import crc_fold, lowered, mix, per_slice, row_index, text_of, word_hashes, word_starts
from tabwright.llm.toxicity import rising
from tabwright.session import settle

FOLDS = 5
#: Random features, and the width of the Gaussian kernel in standard deviations per root of the number of statistics.
FEATURES, WIDTH = 256, 1.0
#: Ridge penalty on the summed normal equations.
PENALTY = 1.0
#: A statistic counts up to so many standard deviations from its mean.
REACH = 6.0
#: Raw scores are calibrated in steps of 1/STEPS from -1 to 2.
STEPS = 1024
#: Documents by which the prior pulls each calibrated value.
PULL = 2.0
SEED = 7

NAMES = (
    "bytes", "words", "word_length", "word_spread", "lower", "upper", "digit", "blank", "newline", "stop", "comma", "symbol",
    "wide", "control", "entropy", "distinct_words", "top_word", "distinct_fours", "capital_words", "symbol_words", "titled_words",
    "doubled_marks", "stop_gap", "line_gap",
)

LOWER, UPPER, DIGIT, BLANK, NEWLINE, STOP, COMMA, SYMBOL, WIDE, CONTROL = range(10)


def _classes() -> np.ndarray:
    kind = np.full(256, CONTROL, np.uint8)
    kind[33:127] = SYMBOL
    kind[97:123], kind[65:91], kind[48:58], kind[128:] = LOWER, UPPER, DIGIT, WIDE
    kind[[32, 9]], kind[[10, 13]] = BLANK, NEWLINE
    kind[[ord(c) for c in ".!?"]] = STOP
    kind[[ord(c) for c in ",;:'\"()-"]] = COMMA
    return kind


_KIND = _classes()


def _runs(rows: np.ndarray, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Different keys of each row, and how often its most frequent one occurs."""
    order = np.lexsort((keys, rows))
    r, k = rows[order], keys[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1])
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(r)))
    most = np.zeros(n, np.int64)
    np.maximum.at(most, r[at], size)
    return np.bincount(r[at], minlength=n), most


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """NAMES of each row's text; an empty text has zeros."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    row = row_index(size)
    kind = _KIND[data]
    by = np.bincount(row * 10 + kind, minlength=n * 10).reshape(n, 10)
    some = np.maximum(size, 1)[:, None]
    seen = np.bincount(row * 256 + data, minlength=n * 256).reshape(n, 256) / some
    entropy = -(seen * np.log2(np.where(seen > 0, seen, 1))).sum(axis=1)
    low = lowered(data)
    starts, words = word_starts(low, offsets)
    w, r = word_hashes(low, starts), row_index(words)
    many = np.maximum(words, 1)

    def per_word(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask.astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)

    def of_words(values: np.ndarray) -> np.ndarray:
        return np.bincount(r, values, minlength=n) / many

    length = per_word((kind != BLANK) & (kind != NEWLINE) & (kind != CONTROL))
    mean = of_words(length)
    spread = np.sqrt(np.maximum(of_words(length.astype(float) ** 2) - mean**2, 0))
    letters, caps = per_word(kind == LOWER), per_word(kind == UPPER)
    distinct, most = _runs(r, w, n)
    four, r4 = w[:0], r[:0]
    if len(w) > 3:
        gold = np.uint64(0x9E3779B97F4A7C15)
        whole = r[3:] == r[:-3]
        four = w[:-3]
        for i in range(1, 4):
            four = mix(four * gold + w[i : len(w) - 3 + i])
        four, r4 = four[whole], r[3:][whole]
    fours = np.bincount(r4, minlength=n)
    mark = (kind == SYMBOL) | (kind == STOP)
    doubled = np.zeros(len(data), bool)
    doubled[1:] = mark[1:] & (data[1:] == data[:-1]) & (row[1:] == row[:-1])
    out = np.column_stack([
        np.log1p(size), np.log1p(words), mean, spread, by / some, entropy, distinct / many, most / many,
        _runs(r4, four, n)[0] / np.maximum(fours, 1), of_words((caps > 1) & (letters == 0)), of_words(per_word(kind == SYMBOL) > 0),
        of_words((kind == UPPER)[starts]) if len(starts) else np.zeros(n), np.bincount(row[doubled], minlength=n) / some[:, 0],
        np.log1p(words / (by[:, STOP] + 1)), np.log1p(words / (by[:, NEWLINE] + 1)),
    ])
    out[size == 0] = 0
    return out


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and ``x``, the statistics of the whole text, for each row of ``docs``."""

    def run(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        x = statistics(data, offsets)
        lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "x"])

    rows = docs.select("doc_id", text_of().alias("text"))
    return rows.mapInArrow(per_slice(run), T.StructType([docs.schema["doc_id"]]).add("x", T.ArrayType(T.DoubleType())))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    #: weights of the random features and what is added for all
    beta: np.ndarray
    base: float
    #: raw scores and the calibrated values between which scores are interpolated
    knots: np.ndarray
    values: np.ndarray


def waves(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised statistics: their products approximate a Gaussian kernel."""
    rng = np.random.default_rng(SEED)
    w = rng.standard_normal((len(mean), FEATURES)) / (WIDTH * np.sqrt(len(mean)))
    shift = rng.uniform(0, 2 * np.pi, FEATURES)
    z = np.clip((x - mean) / scale, -REACH, REACH)
    return np.sqrt(2 / FEATURES) * np.cos(z @ w + shift)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def normal_equations(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, base: float) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'(y - base) of ``rows`` (x, y): a sum per partition, then per row of the matrix over all partitions."""
    width = len(mean)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sums = np.zeros((FEATURES, FEATURES + 1))
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                b = batch.slice(i, 4096)
                z = waves(_matrix(b.column("x"), width), mean, scale)
                y = b.column("y").to_numpy(zero_copy_only=False) - base
                sums += z.T @ np.column_stack([z, y])
        if sums.any():
            at = TaskContext.get().partitionId()
            lines = [s.tobytes() for s in sums]
            yield pa.RecordBatch.from_arrays([pa.array(range(FEATURES), pa.int32()), pa.array([at] * FEATURES, pa.int32()), pa.array(lines, pa.binary())], names=["i", "part", "line"])

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")  # sums of floating numbers depend on their order
        total = np.sum([np.frombuffer(v.as_py()) for v in table.column("line")], axis=0)
        return pa.table({"i": table.column("i").slice(0, 1), "line": pa.array([total.tobytes()], pa.binary())})

    sums = rows.select("x", F.col("y").cast("double").alias("y")).mapInArrow(part, "i int, part int, line binary")
    found = {r["i"]: np.frombuffer(r["line"]) for r in sums.groupBy("i").applyInArrow(add, "i int, line binary").collect()}
    both = np.array([found[i] for i in range(FEATURES)])
    return both[:, :-1], both[:, -1]


def _raw(model: Model, x: np.ndarray) -> np.ndarray:
    return model.base + waves(x, model.mean, model.scale) @ model.beta


def calibrate(bins: np.ndarray, n: np.ndarray, hits: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing curve through shares of ``hits`` at sorted ``bins`` of raw scores.

    Each block of the pooled curve is a knot at its mean raw score, pulled towards the prior by PULL documents.
    """
    level = rising(hits / n, n)
    cut = np.flatnonzero(np.append(True, np.diff(level) > 0))
    at = np.add.reduceat(n * bins, cut) / np.add.reduceat(n, cut)
    total, sure = np.add.reduceat(n, cut), np.add.reduceat(hits, cut)
    return at, np.maximum.accumulate((sure + PULL * prior) / (total + PULL))


def train(stats: DataFrame, labels: DataFrame) -> Model | None:
    """The fit of ``quality`` on folds 1 to 3 of the labelled documents and its calibration on fold 4; fold 0 is held out.

    ``stats`` are ``measured`` rows; all labelled ones are used. An id with several rows counts once, by the least of
    them; an id with several labels by the greatest. Labels other than 0 and 1, and null ids, count as none. None if
    folds 1 to 3 do not hold both classes. Without a label in fold 4 raw scores are taken as they are.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (crc_fold(FOLDS) != 0))
    known = known.groupBy("doc_id").agg(F.max("quality").cast("double").alias("y"))
    once = stats.filter(F.col("doc_id").isNotNull() & (crc_fold(FOLDS) != 0)).groupBy("doc_id").agg(F.min("x").alias("x"))
    rows = settle(once.join(known, "doc_id").withColumn("fold", crc_fold(FOLDS)), "labelled")
    fit, held = rows.filter("fold <> 4"), rows.filter("fold = 4")
    width = len(NAMES)
    x = [F.get("x", F.lit(i)) for i in range(width)]
    sums = fit.agg(F.count(F.lit(1)), F.avg("y"), *[F.avg(c) for c in x], *[F.stddev_pop(c) for c in x]).first()
    n, base = sums[0], sums[1]
    if not n or base in (0.0, 1.0):
        warnings.warn("quality: the training folds do not hold labels of both classes", stacklevel=2)
        return None
    mean, scale = np.array(sums[2 : 2 + width], float), np.array(sums[2 + width :], float)
    scale = np.where(scale > 1e-9, scale, 1.0)
    gram, right = normal_equations(fit, mean, scale, base)
    beta = np.linalg.solve(gram + PENALTY * np.eye(FEATURES), right)
    raw = Model(mean, scale, beta, base, np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = np.floor(np.clip(_raw(raw, _matrix(batch.column("x"), width)), -1, 2) * STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(b), batch.column("y")], names=["b", "y"])

    counts = held.select("x", "y").mapInArrow(binned, "b bigint, y double").groupBy("b").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("hits"))
    counts = sorted(map(tuple, counts.collect()))  # at most 3 * STEPS + 1
    if not counts:
        return raw
    b, seen, hits = np.array(counts, float).T
    return Model(mean, scale, beta, base, *calibrate((b + 0.5) / STEPS, seen, hits, base))


def score(stats: DataFrame, model: Model | None, threshold: float = 0.3) -> DataFrame:
    """doc_id, ``score`` (0 to 1, higher: good quality likelier) and ``predicted`` (1 if score >= threshold) of ``measured`` rows.

    Rows are independent; null and empty texts are scored by their statistics, which are zeros. Repeated rows
    have equal scores. Without a model every score is 0.5. An empty table gives no rows.
    """
    width = len(NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.full(batch.num_rows, 0.5)
            if model is not None and batch.num_rows:
                p = np.clip(np.interp(_raw(model, _matrix(batch.column("x"), width)), model.knots, model.values), 0, 1)
            cols = [batch.column("doc_id"), pa.array(p), pa.array((p >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "score", "predicted"])

    return stats.mapInArrow(run, T.StructType([stats.schema["doc_id"]]).add("score", "double").add("predicted", "integer"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``score`` of every row of ``docs`` by a model trained on ``labels`` (doc_id, quality). Texts are read once; other columns are ignored."""
    stats = settle(measured(docs), "statistics")
    return score(stats, train(stats, labels), threshold)


__all__ = ["classify", "measured", "score", "train"]
