"""Helpers that several of the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.session import settle

#: Rows of a lookup table that may be broadcast; more are joined by shuffle.
BROADCAST_ROWS = 400_000
#: Bytes of text handled by one vectorised step inside a task.
SLICE_BYTES = 1 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(name: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def crc_fold(folds: int, name: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % folds


def checked_broadcast(table: DataFrame, rows: int | None = None) -> DataFrame:
    """``table`` with a broadcast hint if it has at most BROADCAST_ROWS rows, else as it is."""
    n = table.count() if rows is None else rows
    return F.broadcast(table) if n <= BROADCAST_ROWS else table


def keep_rows(docs: DataFrame, ids: DataFrame, how: str, on: list[str] | None = None) -> DataFrame:
    """Semi or anti join of ``docs`` with settled keys; null keys match each other."""
    on = on or ["doc_id"]
    right = checked_broadcast(ids.select(*[F.col(c).alias(f"_k_{c}") for c in on]))
    cond = None
    for c in on:
        e = docs[c].eqNullSafe(right[f"_k_{c}"])
        cond = e if cond is None else cond & e
    return docs.join(right, cond, how)


def first_by(rows: DataFrame, value: Column, count: int) -> list:
    """The ``count`` rows (all, if fewer) of a settled table with the largest ``value``, a whole number from 0, then the smallest hash of the row.

    Only little more than these rows reaches the driver: a histogram of the values by eighths of
    octaves, refined at the border, tells where to cut, and among rows of the border's value a share of the hashes is taken.
    """
    rows = rows.withColumns({"_value": value.cast("bigint"), "_hash": F.xxhash64(*rows.columns)})
    low, inside = 0, rows
    for part in (F.floor(F.log2(F.col("_value") + 1.0) * 8), F.col("_value")):
        border, seen = None, low
        for r in inside.groupBy(part.alias("c")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c")).collect():
            if seen + r["n"] > count:
                border = r["c"]
                break
            seen += r["n"]
        if border is None:
            return _in_order(rows.collect())
        low, inside = seen, inside.filter(part == border)
    ahead = rows.filter(F.col("_value") > border)
    want, tied = count - low, inside.count()
    share = (want + 6 * want**0.5 + 32) / tied
    while True:
        top = min(2**63 - 1, int((min(share, 1.0) - 0.5) * 2**64))
        some = inside.filter(F.col("_hash") <= top).collect()
        if len(some) >= want or share >= 1:
            return _in_order(ahead.collect() + some)[:count]
        share *= 2


def _in_order(found: list) -> list:
    return sorted(found, key=lambda r: (-r["_value"], r["_hash"]))


def positioned(df: DataFrame) -> DataFrame:
    """``df`` with ``_file`` and ``_row``, where each row stands in its Parquet file: the same in every job.

    A frame that does not come from files is written to the shared folder first.
    """
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    try:
        return df.select("*", *place)
    except AnalysisException:
        return settle(df, "positioned").select("*", *place)


def strings(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows; null counts as empty."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    col = pc.fill_null(col.cast(pa.large_string()), "")
    offsets = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8) if len(col) else np.zeros(1, np.int64)
    body = col.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``limit`` bytes each; one long row makes a run of its own."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def per_slice(fn: Callable[[pa.RecordBatch, np.ndarray, np.ndarray], pa.RecordBatch | None], text: str = "text"):
    """A mapInArrow function that calls ``fn`` with runs of rows, their bytes and their offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = strings(batch.column(text))
            for i, j in slices(offsets):
                out = fn(batch.slice(i, j - i), data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                if out is not None and out.num_rows:
                    yield out

    return run


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z made lower case; other bytes stay."""
    return _LOWER[data]


def word_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions where words (runs of bytes other than 20 and 09-0D) begin, and the words of each row."""
    solid = ~SPACE[data]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    edge = offsets[:-1][offsets[:-1] < len(data)]
    begin[edge] = solid[edge]
    starts = np.flatnonzero(begin)
    return starts, np.diff(np.searchsorted(starts, offsets))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
_BYTE[SPACE] = 0
_BASE = 0xD1342543DE82EF95
#: Bytes whose powers are kept; text is hashed in runs of words no longer than that.
_RUN = SLICE_BYTES
_POWERS: dict[str, np.ndarray] = {}


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(_RUN + 1, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def _long_word(word: np.ndarray) -> np.uint64:
    """The sum of a word of any length, run by run."""
    up, _ = _powers()
    total = 0
    for i in range(0, len(word), _RUN):
        run = word[i : i + _RUN]
        total += int(np.sum(_BYTE[run] * up[: len(run)])) * pow(_BASE, i, 1 << 64)
    return np.uint64(total % (1 << 64))


def word_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, the same wherever the word stands.

    A word is a number in base _BASE with a digit per byte; blanks are zero. Sums are taken
    over runs of about _RUN bytes, so memory does not grow with the text.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers()
    sums = np.zeros(len(starts), np.uint64)
    stops = np.append(starts[1:], len(data))
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(stops, starts[i] + _RUN, "right")))
        run = data[starts[i] : stops[j - 1]]
        if len(run) > _RUN:
            sums[i] = _long_word(run)
        else:
            at = starts[i:j] - starts[i]
            sums[i:j] = np.add.reduceat(_BYTE[run] * up[: len(run)], at) * down[at]
        i = j
    return mix(sums)


def row_index(counts: np.ndarray) -> np.ndarray:
    """0 repeated counts[0] times, 1 repeated counts[1] times, and so on."""
    return np.repeat(np.arange(len(counts)), counts)

