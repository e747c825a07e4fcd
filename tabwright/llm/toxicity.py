"""Toxicity by compression distance: a dictionary of toxic text against one of ordinary text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.base import crc_fold, text_of
from tabwright.session import settle

#: Labelled documents per class that train the dictionaries, and that set the thresholds.
TRAIN_DOCS, CALIBRATION_DOCS = 10_000, 5_000
#: Bytes of a window and from one window to the next.
WINDOW, STEP = 64, 48
#: Bytes of shared text that every window is followed by.
PAD = 32
#: Bytes of the part that both dictionaries share, and of each one's own part.
SHARED_BYTES, OWN_BYTES = 8192, 4096
#: Windows of ordinary text that train the shared part.
SHARED_WINDOWS, SHARED_WINDOW = 20_000, 256
#: Documents that a class must have in excess of chance, in standard deviations, for a word to be its own.
MIN_Z = 8.0
#: Words of a class that its own part is trained on.
OWN_WORDS = 20_000
#: Differences of compressed lengths are counted from LOW to HIGH bytes; those outside count with the ends.
LOW, HIGH = -6, 9
FOLDS = 5

_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def normalised(text: str) -> bytes:
    """Lower-case letters with one blank around and between words."""
    return b" " + b" ".join(text.lower().encode().translate(_LETTERS).split()) + b" "


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    #: log-odds of a window by its length difference, LOW to HIGH
    weights: tuple[float, ...]
    #: intercept, and coefficients of weight per window, of windows past the thresholds of two and three bytes, of all windows
    coef: tuple[float, ...]
    #: share of toxic documents among the labelled ones, for texts without any word
    prior: float


@lru_cache(maxsize=4)
def _compressors(ordinary: bytes, toxic: bytes):
    import zstandard as zs

    out = []
    for body in (ordinary, toxic):
        params = zs.ZstdCompressionParameters.from_level(
            3, source_size=WINDOW + PAD, dict_size=len(body), min_match=6, strategy=zs.STRATEGY_GREEDY, format=zs.FORMAT_ZSTD1_MAGICLESS,
            write_content_size=0, write_checksum=0, write_dict_id=0,
        )
        words = zs.ZstdCompressionDict(body, dict_type=zs.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(compression_params=params)
        out.append(zs.ZstdCompressor(dict_data=words, compression_params=params).compress)
    return out


def histogram(text: str, ordinary: bytes, toxic: bytes) -> np.ndarray:
    """Windows of a text by how many bytes the toxic dictionary saves over the ordinary one."""
    plain, rude = _compressors(ordinary, toxic)
    b = normalised(text)
    if not b.strip():
        return np.zeros(HIGH - LOW + 1, np.int64)
    # text that both dictionaries have makes every window compressible: a block that is not is stored as it is
    pad = ordinary[SHARED_BYTES - 2 * PAD : SHARED_BYTES - PAD]
    saved = [len(plain(w)) - len(rude(w)) for w in (b[i : i + WINDOW] + pad for i in range(0, max(1, len(b) - WINDOW + STEP), STEP))]
    return np.bincount(np.clip(saved, LOW, HIGH) - LOW, minlength=HIGH - LOW + 1)


def _cover(size: int, samples: list[bytes], k: int) -> bytes:
    """A trained dictionary's bytes, at the end of a zero-filled buffer of ``size``."""
    import zstandard as zs

    try:
        found = zs.train_dictionary(size, samples, k=k, d=6).as_bytes()
    except zs.ZstdError:  # too little text to train on: the text itself
        found = b"".join(samples)
    return found[-size:].rjust(size, b"\0")


def dictionaries(shared: list[bytes], own: dict[int, list[tuple[str, int]]]) -> tuple[bytes, bytes]:
    """The ordinary and the toxic dictionary.

    Both hold the same part trained on ordinary windows, so that common text compresses
    alike with either; each ends with a part trained on its own class's words.
    """
    base = _cover(SHARED_BYTES, shared, 48)
    out = []
    for c in (0, 1):
        # words in turns: the trainer looks at stretches of the samples, and each should hold all words
        words = [b" " + w.encode() + b" " for w, _ in own.get(c, [])]
        most = max((n for _, n in own.get(c, [])), default=1)
        rounds = max(1, min(100, 200_000 // max(1, len(words))))
        samples = [w for k in range(rounds) for w, (_, n) in zip(words, own.get(c, []), strict=True) if n * rounds >= k * most]
        out.append(base + _cover(OWN_BYTES, samples, 16) if samples else base + bytes(OWN_BYTES))
    return out[0], out[1]


def _features(h: np.ndarray, weights: np.ndarray) -> np.ndarray:
    n, some, more = h.sum(axis=1), h[:, 2 - LOW :].sum(axis=1), h[:, 3 - LOW :].sum(axis=1)
    per = np.maximum(n, 1)
    return np.column_stack([np.ones(len(h)), h @ weights / per, 10 * more / per, np.log1p(some), np.log1p(more), np.log1p(n)])


def rising(values: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """The non-decreasing values nearest to ``values``, pooled by ``mass``."""
    blocks: list[list[float]] = []
    for v, m in zip(values.tolist(), mass.tolist(), strict=True):
        blocks.append([v, m, 1])
        while len(blocks) > 1 and blocks[-2][0] > blocks[-1][0]:
            v1, m1, n1 = blocks.pop()
            v0, m0, n0 = blocks.pop()
            blocks.append([(v0 * m0 + v1 * m1) / (m0 + m1), m0 + m1, n0 + n1])
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def calibrate(h: np.ndarray, y: np.ndarray, prior: float) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """Weights of the window thresholds and the logistic fit over them.

    The sample holds as many documents of either class as the bounds allow; the intercept
    is set for a share of ``prior`` toxic ones.
    """
    pooled = (h.sum(axis=0) + 0.01) / (h.sum() + 0.01 * h.shape[1])
    both = [(h[y == c].sum(axis=0) + 20 * pooled) / (h[y == c].sum() + 20) for c in (0, 1)]
    weights = rising(np.log(both[1] / both[0]), pooled)  # a larger saving never speaks against toxicity
    x, beta = _features(h, weights), np.zeros(6)
    ridge = np.diag([1e-6, *[1e-2] * 5])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    beta[0] += np.log(prior / (1 - prior)) - np.log(y.mean() / (1 - y.mean()))
    return tuple(weights.tolist()), tuple(beta.tolist())


def _sample(docs: DataFrame, labels: DataFrame, folds: tuple[int, ...], per_class: int) -> DataFrame:
    """(doc_id, toxic, text) of labelled documents in ``folds``, the ``per_class`` with the smallest hashes.

    Of copies and near copies one is taken: what they share would else pass for typical of their class.
    Rows that agree in the least hash of their three-word runs are taken for copies, under three hashes in turn.
    """
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.filter(crc_fold(FOLDS).isin(*folds))
    parts = [known.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    chosen = settle(parts[0].union(parts[1]), "labelled")
    texts = docs.select("doc_id", text_of().alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").withColumn("_w", F.split(F.lower("text"), "\\s+"))
    least = []
    for seed in range(3):
        run = lambda i, seed=seed: F.xxhash64(F.lit(seed), F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2))
        least.append(F.array_min(F.transform(F.sequence(F.lit(0), F.greatest(F.size("_w") - 3, F.lit(0))), run)).alias(f"_{seed}"))
    some = settle(rows.select("doc_id", "toxic", *least), "sketch")
    for seed in range(3):
        some = some.groupBy(f"_{seed}").agg(F.min_by(F.struct("doc_id", "toxic", *[f"_{s}" for s in range(3) if s != seed]), "doc_id").alias("_row")).select(f"_{seed}", "_row.*")
    return texts.join(F.broadcast(settle(some.select("doc_id", "toxic"), "labelled")), "doc_id")


def _own_words(rows: DataFrame, totals: dict[int, int]) -> dict[int, list[tuple[str, int]]]:
    """Words that one class has in more of its documents than chance explains, with their documents."""
    words = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[\\p{Ll}\\p{Lo}\\p{M}]+"), F.lit(0)))).alias("w")
    by = rows.select("toxic", words).groupBy("w").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).filter(F.length("w").between(3, 40))
    n1, n0 = float(totals[1]), float(totals[0])
    p = (F.col("a") + F.col("b")) / (n1 + n0)
    by = by.withColumn("z", (F.col("a") / n1 - F.col("b") / n0) / F.sqrt(p * (1 - p) * (1 / n1 + 1 / n0) + 1e-12))
    out = {}
    for c, seen, z in ((1, "a", F.col("z")), (0, "b", -F.col("z"))):
        top = by.filter((z >= MIN_Z) & (F.col(seen) >= 5)).orderBy(F.desc(z), "w").limit(OWN_WORDS)
        out[c] = [(r["w"], int(r[seen])) for r in top.select("w", seen).collect()]
    return out


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, calibration_docs: int = CALIBRATION_DOCS) -> Model | None:
    """Dictionaries from folds 1 to 3 and thresholds from fold 4 of the labelled documents; fold 0 is held out.

    At most ``train_docs`` and ``calibration_docs`` documents per class are used, chosen by
    hash. None if a class has no document in either part.
    """
    rows = settle(_sample(docs, labels, (1, 2, 3), train_docs), "sample")
    held = _sample(docs, labels, (4,), calibration_docs)
    totals = {c: n for c, n in rows.groupBy("toxic").count().collect()}
    if len(totals) < 2:
        return None
    starts = F.sequence(F.lit(1), F.greatest(F.length("text"), F.lit(1)), F.lit(SHARED_WINDOW))
    windows = F.posexplode(F.transform(starts, lambda i: F.substr("text", i, F.lit(SHARED_WINDOW)))).alias("at", "t")
    windows = rows.filter("toxic = 0").select("doc_id", windows)
    shared = windows.orderBy(F.xxhash64("doc_id", "at"), "doc_id", "at").select("t").limit(SHARED_WINDOWS).collect()
    shared = [w for r in shared if (w := normalised(r["t"])).strip()]
    ordinary, toxic = dictionaries(shared, _own_words(rows, totals))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = [histogram(t.as_py(), ordinary, toxic).tolist() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(h, pa.list_(pa.int64()))], names=["toxic", "h"])

    seen = held.select("toxic", "text").mapInArrow(run, "toxic int, h array<bigint>").collect()
    if len({r["toxic"] for r in seen}) < 2:
        return None
    known = labels.filter(F.col("toxic").isin(0, 1) & (crc_fold(FOLDS) != 0))
    prior = known.agg((F.sum("toxic") / F.count(F.lit(1))).alias("p")).first()["p"]
    weights, coef = calibrate(np.array([r["h"] for r in seen], float), np.array([r["toxic"] for r in seen], float), prior)
    return Model(ordinary, toxic, weights, coef, prior)


def _probability(h: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Scores and numbers of windows of texts by their histograms."""
    logit = _features(h, np.array(model.weights)) @ np.array(model.coef)
    n = h.sum(axis=1).astype(np.int64)
    return np.where(n > 0, 1 / (1 + np.exp(-np.clip(logit, -500, 500))), model.prior), n


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: toxic likelier), ``predicted`` (1 if score >= 0.5) and ``n_windows``.

    Each text is normalised to lower-case words and cut into overlapping windows; each
    window is compressed with both dictionaries, and the thresholds that its length
    difference passes add up. Null and empty texts have no window and get the score of the prior.
    Rows are independent. Without a model every score is 0. Input columns
    of the three names are replaced.
    """
    docs = docs.drop("score", "predicted", "n_windows")
    names = docs.columns
    schema = T.StructType([*docs.schema.fields]).add("score", "double").add("predicted", "integer").add("n_windows", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                p, n = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            else:
                h = [histogram(t.as_py() or "", model.ordinary, model.toxic) for t in batch.column("text")]
                p, n = _probability(np.array(h, float).reshape(-1, HIGH - LOW + 1), model)
            cols = [*batch.columns, pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(n)]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, "score", "predicted", "n_windows"])

    return docs.mapInArrow(run, schema)


def verdict(text: Column, model: Model | None) -> Column:
    """``score`` of a text column as a column: only the texts go to Python, and only scores come back."""

    def run(texts: pa.Array) -> pa.Array:
        if model is None:
            return pa.array(np.zeros(len(texts)))
        h = np.zeros((len(texts), HIGH - LOW + 1))
        for i, t in enumerate(texts):
            h[i] = histogram(t.as_py() or "", model.ordinary, model.toxic)
        return pa.array(_probability(h, model)[0])

    return F.arrow_udf(run, "double")(text)


__all__ = ["Model", "score", "train", "verdict"]
