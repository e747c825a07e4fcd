"""Language-model scores by prediction by partial matching over bytes, beside a word unigram base."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.base import crc_fold, lowered, mix, positioned, row_index, slices, strings, text_of, word_hashes, word_starts
from tabwright.session import settle

#: Bytes of context.
ORDER = 5
#: Levels up to this one are broadcast: all their symbols, 2**24 at most. Longer contexts stay in Spark tables.
LOW = 2
#: Groups that the contexts of LOW + 1 bytes are dealt to: so many at least, and one per so many bytes of text.
GROUPS, GROUP_BYTES = 1024, 4 << 20
#: Bytes of text whose words and symbols share one table.
CHUNK_BYTES = 10 << 20
#: Bytes of text taken at a time: every byte needs some ten numbers meanwhile.
STEP_BYTES = 1 << 19
#: Counts that a task holds back before it sends them on.
HELD = 800_000
FOLDS = 10
#: Neither byte occurs in UTF-8: what stands before a text, and its end.
START, END = 0xFF, 0xFE
_U = np.uint64


def framed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all symbols (ORDER bytes of context, then the symbol), their rows' counts, and the symbols' rows.

    Each text is preceded by START bytes and followed by END.
    """
    n, lens = len(offsets) - 1, np.diff(offsets)
    body = np.full(len(data) + n * (ORDER + 1), START, np.uint8)
    begin = offsets[:-1] + np.arange(n) * (ORDER + 1)
    body[np.arange(len(data)) + np.repeat((np.arange(n) + 1) * (ORDER + 1) - 1, lens)] = data
    body[begin + ORDER + lens] = END
    wide = body.astype(_U)
    keys = wide.copy()
    for j in range(1, ORDER + 1):
        keys[j:] |= wide[: len(wide) - j] << _U(8 * j)
    counts = lens + 1
    at = np.arange(int(counts.sum())) + np.repeat((np.arange(n) + 1) * ORDER, counts)
    return keys[at], counts, row_index(counts)


class _Held:
    """Counts by key, summed now and then."""

    def __init__(self):
        self.parts, self.size, self.enough = [], 0, HELD

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.size += len(keys)
        if self.size > self.enough:
            self.parts = [self.summed()]
            self.size = len(self.parts[0][0])
            self.enough = max(HELD, 2 * self.size)

    def summed(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, _U), np.zeros(0, np.int64)
        keys, where = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
        return keys, np.bincount(where, np.concatenate([c for _, c in self.parts]), len(keys)).astype(np.int64)


def _pack(x: np.ndarray) -> bytes:
    """8-byte numbers compressed byte plane by byte plane."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpack(raw: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _keys_of(packed: list[bytes]) -> list[np.ndarray]:
    return [np.cumsum(_unpack(x, _U), dtype=_U) for x in packed]


#: Bits of the context bytes next to a symbol that groups go by, and of those farther off.
_NEAR, _FAR = _U(8 * (LOW + 1)), _U(8 * (ORDER - LOW - 1))


def _ones(bits: np.uint64) -> np.uint64:
    return _U((1 << int(bits)) - 1)


def _turned(keys: np.ndarray) -> np.ndarray:
    """Symbols with the near context bytes in front: in this order the symbols of a group pack to some 60 %."""
    return ((keys >> _U(8) & _ones(_NEAR)) << (_FAR + _U(8))) | ((keys >> (_NEAR + _U(8))) << _U(8)) | (keys & _U(255))


def _turned_back(keys: np.ndarray) -> np.ndarray:
    return ((keys >> _U(8) & _ones(_FAR)) << (_NEAR + _U(8))) | ((keys >> (_FAR + _U(8))) << _U(8)) | (keys & _U(255))


def _packed(chunk: int, keys: np.ndarray, n: np.ndarray, bucket: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(bucket, chunk, keys, n): counts packed by bucket, with the keys in order."""
    order = np.lexsort((keys, bucket))
    keys, n, bucket = keys[order], n[order], bucket[order]
    cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
    for i in range(0, len(cuts) - 1, 1000):
        spans = list(zip(cuts[i : i + 1000].tolist(), cuts[i + 1 : i + 1001].tolist(), strict=False))
        cols = [
            pa.array(bucket[[a for a, _ in spans]]),
            pa.array(np.full(len(spans), chunk)),
            pa.array([_pack(np.diff(keys[a:b], prepend=_U(0))) for a, b in spans], pa.binary()),
            pa.array([_pack(n[a:b]) for a, b in spans], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(cols, names=["bucket", "chunk", "keys", "n"])


def _joined(parts: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(chunk, bytes, offsets, train) of runs of rows of one chunk."""
    for batch in batches:
        data, offsets = strings(batch.column("text"))
        train, chunks = batch.column("train").to_numpy(zero_copy_only=False), batch.column("chunk").to_numpy()
        for i, j in slices(offsets, STEP_BYTES):
            for a, b in _runs(chunks, i, j):
                yield int(chunks[a]), lowered(data[offsets[a] : offsets[b]]), offsets[a : b + 1] - offsets[a], train[a:b]


def _by_chunk(steps: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(chunk, keys, counts) added up; those of a chunk may come in several parts."""
    held: dict[int, _Held] = {}
    for chunk, keys, counts in steps:
        if chunk not in held and len(held) > 2:  # rows come file by file: the oldest chunk is done
            old = next(iter(held))
            yield old, *held.pop(old).summed()
        held.setdefault(chunk, _Held()).add(keys, counts)
    for chunk in list(held):
        yield chunk, *held.pop(chunk).summed()


def _counts_in(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    known, where = np.unique(keys, return_inverse=True)
    return known, np.bincount(where, train.astype(np.float64), len(known)).astype(np.int64)


def _words(groups: int):
    """(bucket, chunk, keys, n): the words of each chunk by hash, and how often its training rows have them, packed by group of words.

    Beside them (key, m): the symbols of level LOW.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _low.cache_clear()  # a worker that lives on may hold an earlier model
        low = _Held()

        def steps() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            for chunk, data, offsets, train in _steps(batches):
                starts, counts = word_starts(data, offsets)
                yield chunk, *_counts_in(word_hashes(data, starts), train[row_index(counts)])
                keys, _, row = framed(data, offsets)
                keys, n = np.unique((keys[train[row]] & _U((1 << (8 * (LOW + 1))) - 1)).astype(np.uint32), return_counts=True)
                low.add(keys.astype(_U), n)

        def rows(**cols: pa.Array) -> pa.RecordBatch:
            size = len(next(iter(cols.values())))
            kinds = {"bucket": pa.int64(), "chunk": pa.int64(), "keys": pa.binary(), "n": pa.binary(), "key": pa.int64(), "m": pa.int64()}
            return pa.RecordBatch.from_arrays([cols[c] if c in cols else pa.nulls(size, t) for c, t in kinds.items()], names=list(kinds))

        for chunk, keys, n in _by_chunk(steps()):
            for part in _packed(chunk, keys, n, (keys % _U(groups)).astype(np.int64)):
                yield rows(**{c: part.column(c) for c in part.schema.names})
        keys, n = low.summed()
        for i in range(0, len(keys), 100_000):
            yield rows(key=pa.array(keys[i : i + 100_000].astype(np.int64)), m=pa.array(n[i : i + 100_000]))

    return run


def _added_up(table: pa.Table) -> pa.Table:
    """The words of one group, chunk by chunk, with their counts in all chunks; the first row has the group's sums."""
    packed = table.column("keys").to_pylist()
    parts = _keys_of(packed)
    n = np.concatenate([_unpack(x, np.int64) for x in table.column("n").to_pylist()])
    keys, where = np.unique(np.concatenate(parts), return_inverse=True)
    c = np.bincount(where, n, len(keys)).astype(np.int64)
    cut = np.cumsum([0, *map(len, parts)])
    counts = [_pack(c[where[a:b]]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    first = np.zeros(len(parts), np.int64)
    first[0] = 1
    sums = {"total": pa.array(first * int(c.sum())), "kinds": pa.array(first * int((c > 0).sum()))}
    return pa.table({"chunk": table.column("chunk"), "keys": pa.array(packed, pa.binary()), "c": pa.array(counts, pa.binary()), **sums})


def _symbols(groups: int):
    """(bucket, chunk, keys, n): the symbols of each chunk, and how often its training rows have them, packed by group of contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def steps() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            for chunk, data, offsets, train in _steps(batches):
                keys, _, row = framed(data, offsets)
                yield chunk, *_counts_in(keys, train[row])

        for chunk, keys, n in _by_chunk(steps()):
            bucket = (mix((keys >> _U(8)) & _ones(_NEAR)) % _U(groups)).astype(np.int64)
            yield from _packed(chunk, _turned(keys), n, bucket)

    return run


def _runs(chunks: np.ndarray, i: int, j: int) -> Iterator[tuple[int, int]]:
    cuts = [i, *(np.flatnonzero(np.diff(chunks[i:j])) + i + 1).tolist(), j]
    yield from zip(cuts[:-1], cuts[1:], strict=True)


class Trie:
    """Counts of symbols after contexts of 0 to ORDER bytes, ready to look up.

    With ``low``, a trie of the lowest levels, ``levels`` are those above it.
    """

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]], low: Trie | None = None):
        first = len(low.keys) if low else 0
        self.keys = [*(low.keys if low else ()), *(k for k, _ in levels)]
        self.counts = [*(low.counts if low else ()), *(c.astype(np.float64) for _, c in levels)]
        self.contexts, self.total, self.kinds, self.below = ([*getattr(low, x)] if low else [] for x in ("contexts", "total", "kinds", "below"))
        for k, (keys, counts) in enumerate(zip(self.keys, self.counts, strict=True)):
            if k < first:
                continue
            ctx, where = np.unique(keys >> _U(8), return_inverse=True)
            self.contexts.append(ctx)
            self.total.append(np.bincount(where, counts, len(ctx)))
            self.kinds.append(np.bincount(where, minlength=len(ctx)).astype(np.float64))
            # mass that the symbols seen here have one level down, where they are excluded
            mass = self._count(k - 1, keys & _U((1 << (8 * k)) - 1)) if k else np.zeros(len(keys))
            self.below.append(np.bincount(where, mass, len(ctx)))
        top = len(self.keys) - 1
        at = np.searchsorted(self.contexts[top], self.keys[top] >> _U(8))
        whole = self.total[top] + self.kinds[top]
        self._hash(self.keys[top], np.log10(self.counts[top] / whole[at]) if len(at) else np.zeros(0))
        self.top = top

    def _hash(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(4, (3 * len(keys) // 2).bit_length())
        size = 1 << self.bits
        self.slot_key, self.slot_value = np.full(size, _U(2**64 - 1)), np.zeros(size, np.float64)
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.slot_key[at[todo]] == _U(2**64 - 1)
            _, first = np.unique(at[todo][free], return_index=True)
            put = todo[free][first]
            self.slot_key[at[put]], self.slot_value[at[put]] = keys[put], values[put]
            todo = todo[self.slot_key[at[todo]] != keys[todo]]
            at[todo] = (at[todo] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _U(0x9E3779B97F4A7C15)) >> _U(64 - self.bits)).astype(np.int64)

    def _count(self, k: int, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys[k]):
            return np.zeros(len(keys))
        at = np.minimum(np.searchsorted(self.keys[k], keys), len(self.keys[k]) - 1)
        return np.where(self.keys[k][at] == keys, self.counts[k][at], 0.0)

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of each symbol after its context.

        A symbol not seen after a context escapes to the context one byte shorter, with
        probability kinds / (kinds + total) of what was seen. The symbols of the longer context are excluded
        there, from counts and kinds. Below the empty context all other byte values are alike.
        """
        at, out = self._slot(keys), np.zeros(len(keys))
        found = self.slot_key[at]
        hit = found == keys
        out[hit] = self.slot_value[at[hit]]
        todo = np.flatnonzero(~hit)
        probe = todo[found[todo] != _U(2**64 - 1)]
        place = at[probe]
        while len(probe):
            place = (place + 1) & (len(self.slot_key) - 1)
            got = self.slot_key[place]
            same = got == keys[probe]
            out[probe[same]] = self.slot_value[place[same]]
            hit[probe[same]] = True
            go = ~same & (got != _U(2**64 - 1))
            probe, place = probe[go], place[go]
        todo = np.flatnonzero(~hit)
        if len(todo):
            out[todo] = self._fallback(keys[todo])
        return out

    def _fallback(self, keys: np.ndarray) -> np.ndarray:
        out, open_ = np.zeros(len(keys)), np.arange(len(keys))
        less, fewer = np.zeros(len(keys)), np.zeros(len(keys))  # mass and kinds excluded at this level
        for k in range(self.top, -1, -1):
            if not len(open_):
                break
            key = keys[open_] & _U((1 << (8 * (k + 1))) - 1)
            ctx, n = key >> _U(8), len(self.contexts[k])
            if not n:
                continue
            at = np.minimum(np.searchsorted(self.contexts[k], ctx), n - 1)
            there = self.contexts[k][at] == ctx
            total = np.where(there, self.total[k][at], 0.0) - less[open_]
            kinds = np.where(there, self.kinds[k][at], 0.0) - fewer[open_]
            there &= kinds > 0.5
            count = np.where(there, self._count(k, key), 0.0)
            whole = np.where(there, np.maximum(total, 0.0) + kinds, 1.0)
            seen = count > 0
            out[open_[seen]] += np.log10(count[seen] / whole[seen])
            out[open_[there & ~seen]] += np.log10(kinds[there & ~seen] / whole[there & ~seen])
            known = self.contexts[k][at] == ctx
            less[open_] = np.where(known, self.below[k][at], 0.0)
            fewer[open_] = np.where(known, self.kinds[k][at], 0.0)
            open_ = open_[~seen]
        out[open_] -= np.log10(np.maximum(1.0, 256.0 - fewer[open_]))
        return out


@lru_cache(maxsize=1)
def _low(held) -> Trie:
    return Trie(held.value)


def _levels(keys: np.ndarray, n: np.ndarray, top: int, last: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The counts of levels ``last`` to ``top``, from those of level ``top`` (sorted keys)."""
    out = [(keys, n)]
    for k in range(top - 1, last - 1, -1):
        up, c = out[-1]
        keys, where = np.unique(up & _U((1 << (8 * (k + 1))) - 1), return_inverse=True)
        out.append((keys, np.bincount(where, c, len(keys))))
    return out[::-1]


def _low_levels(level: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """The counts of levels 0 to LOW, from the counts (key, m) of level LOW."""
    got = level.groupBy("key").agg(F.sum("m").alias("n")).toArrow()
    keys, n = got.column("key").to_numpy().astype(_U), got.column("n").to_numpy()
    order = np.argsort(keys)
    return _levels(keys[order], n[order], LOW, 0)


def _valued(symbols: DataFrame, low: DataFrame) -> DataFrame:
    """(chunk, keys, logs, place): the log10 probabilities of each chunk's symbols after their contexts.

    All that a symbol's escapes may come to has the same LOW + 1 bytes of context or fewer. So ``symbols`` are
    grouped by these bytes, and each group is scored by a trie of its own above the broadcast levels.
    """
    held = symbols.sparkSession.sparkContext.broadcast(_low_levels(low))

    def run(table: pa.Table) -> pa.Table:
        packed = table.column("keys").to_pylist()
        parts = _keys_of(packed)
        n = np.concatenate([_unpack(x, np.int64) for x in table.column("n").to_pylist()])
        keys, where = np.unique(_turned_back(np.concatenate(parts)), return_inverse=True)
        n = np.bincount(where, n, len(keys)).astype(np.int64)
        value = Trie(_levels(keys[n > 0], n[n > 0], ORDER, LOW + 1), _low(held)).log10(keys)[where]
        logs, place, at = [], [], 0
        for part in parts:
            u, inverse = np.unique(value[at : at + len(part)], return_inverse=True)
            at += len(part)
            logs.append(_pack(u))
            place.append(_pack(inverse.astype(np.int64)))
        return pa.table({"chunk": table.column("chunk"), "keys": pa.array(packed, pa.binary()), "logs": pa.array(logs, pa.binary()), "place": pa.array(place, pa.binary())})

    return symbols.groupBy("bucket").applyInArrow(run, "chunk bigint, keys binary, logs binary, place binary")


_SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def score(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Trained on the documents whose fold is not 0; bytes A-Z are lower-cased. ``score`` is the
    log10 probability of the text and its end under the byte trie, with escapes and
    exclusion. ``base_score`` sums smoothed unigram log10 probabilities of words and the end token.

    Two passes count, per chunk of neighbouring rows, words by 64-bit hash (two of ten million words share one with
    probability 3e-6) and symbols with their contexts. Both are packed by group of words or contexts. Counts are added over all chunks; what a symbol or word
    adds to a score is sent back to the chunks that have it, and a last pass scores each chunk with its own
    table. All contexts count, however many there are. Nothing of the size of the vocabulary or of the longer contexts is
    broadcast, only the counts after up to LOW bytes.

    Null and empty texts are scored by their end alone. Repeated rows count as often as they occur. A null
    id has the fold of the empty text. Other columns are ignored. Empty tables give no rows; without
    training rows every byte is as likely as any other.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"), (crc_fold(FOLDS) == 0).alias("held_out"))
    rows = positioned(rows)
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    per_chunk = max(1, int(CHUNK_BYTES / max(1.0, size["b"] / max(1, size["n"]))))
    rows = rows.withColumn("chunk", F.xxhash64("_file", F.floor(F.col("_row") / per_chunk)))
    groups = max(GROUPS, int(size["b"]) // GROUP_BYTES)
    learned = rows.select("text", (~F.col("held_out")).alias("train"), "chunk")
    parts = settle(learned.mapInArrow(_words(groups), "bucket bigint, chunk bigint, keys binary, n binary, key bigint, m bigint"), "words")
    words = parts.filter("keys is not null").select("bucket", "chunk", "keys", "n").groupBy("bucket")
    words = settle(words.applyInArrow(_added_up, "chunk bigint, keys binary, c binary, total bigint, kinds bigint"), "words")
    ends = rows.filter(~F.col("held_out")).count()
    sums = words.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "kinds")]).first()
    total, kinds = int(sums["total"]) + ends, int(sums["kinds"]) + (ends > 0)
    base = math.log10(total + 0.1 * (kinds + 1))
    deep = _valued(learned.mapInArrow(_symbols(groups), "bucket bigint, chunk bigint, keys binary, n binary"), parts.filter("key is not null").select("key", "m"))
    table = words.select("chunk", "keys", "c").unionByName(deep, allowMissingColumns=True)
    texts = rows.select("chunk", "doc_id", "held_out", "text")

    def run(left: pa.Table, right: pa.Table) -> Iterator[pa.Table] | pa.Table:
        plain_rows = right.filter(right.column("c").is_valid())
        known = _joined(_keys_of(plain_rows.column("keys").to_pylist()), _U)
        c = _joined([_unpack(x, np.int64) for x in plain_rows.column("c").to_pylist()], np.int64)
        order = np.argsort(known)
        known, c = known[order], c[order]
        packed = right.filter(right.column("logs").is_valid())
        symbols = _turned_back(_joined(_keys_of(packed.column("keys").to_pylist()), _U))
        pairs = zip(packed.column("logs").to_pylist(), packed.column("place").to_pylist(), strict=True)
        logs = _joined([_unpack(u, np.float64)[_unpack(i, np.int64)] for u, i in pairs], np.float64)
        order = np.argsort(symbols)
        symbols, logs = symbols[order], logs[order]
        value = np.log10(c + 0.1) - base
        data, offsets = strings(left.column("text"))
        n_tokens, n_known, plain, deep = ([] for _ in range(4))
        for i, j in slices(offsets, STEP_BYTES):
            some, at = lowered(data[offsets[i] : offsets[j]]), offsets[i : j + 1] - offsets[i]
            starts, per_row = word_starts(some, at)
            where, row = np.searchsorted(known, word_hashes(some, starts)), row_index(per_row)
            n_tokens.append(per_row + 1)
            n_known.append(np.bincount(row, c[where] > 0, j - i).astype(np.int64) + (ends > 0))
            plain.append(np.bincount(row, value[where], j - i) + math.log10(ends + 0.1) - base)
            own, _, row = framed(some, at)
            own, where = np.unique(own, return_inverse=True)
            deep.append(np.bincount(row, logs[np.searchsorted(symbols, own)][where], j - i))
        cols = [np.concatenate(x) for x in (n_tokens, n_known, plain, deep)]
        kinds_ = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
        arrays = [pa.array(x, t) for x, t in zip(cols, kinds_, strict=True)]
        head = [left.column(x).combine_chunks() for x in ("doc_id", "held_out")]
        return pa.table([*head, *arrays], names=[x.split()[0] for x in _SCORES.split(", ")])

    out = texts.groupBy("chunk").cogroup(table.groupBy("chunk")).applyInArrow(run, _SCORES)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score")
