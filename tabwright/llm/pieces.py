"""Piece encoding with seeded merge-dropout, and decoding."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.base import mix, slices, strings

#: Words whose plain segmentation a worker remembers.
REMEMBERED = 250_000
#: Bytes of text that are segmented at a time.
STEP_BYTES = 1 << 20
#: Longer words take the agenda, one by one.
ROW_CHARS = 32
MARK = "▁"
_C = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_MASK = 2**64 - 1
NONE = np.int32(2**31 - 1)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A vocabulary of merge pieces with byte fallback, and its merges as a table of pairs."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.plain = {sp.id_to_piece(i): i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
        self.byte_id = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.rank = np.full(n, NONE, np.int32)
        by_score = sorted(self.plain.values(), key=lambda i: (-sp.get_score(i), i))
        self.rank[by_score] = np.arange(len(by_score), dtype=np.int32)
        self.bytes = [b""] * n
        for p, i in self.plain.items():
            self.bytes[i] = p.replace(MARK, " ").encode()
        for b, i in self.byte_id.items():
            self.bytes[i] = bytes([b])
        long = [p for p in self.plain if len(p) > 1]
        if any(MARK in p.lstrip(MARK) for p in long):
            raise ValueError("a piece has a blank after another character: words cannot be taken apart")
        active = sorted({c for p in long for c in p} - {MARK})
        cls = "".join(map(re.escape, active))
        #: words that no merge crosses: blanks with what follows them, or one character that no merge touches
        self.words = re.compile(f" *[{cls}]+| +|[^ {cls}]", re.S).findall
        # characters as ids; those without a piece that are one byte take the byte's id
        self.char_id = np.full(0x110000, -1, np.int32)
        for b in range(128):
            self.char_id[b] = self.byte_id[b]
        for p, i in self.plain.items():
            if len(p) == 1 and p != MARK:
                self.char_id[ord(p)] = i
        self.char_id[0x20] = self.plain[MARK]
        self.char_id[ord(MARK)] = -1  # the sign itself goes as bytes, so that it is not read back as a blank
        self._pairs({(self.plain[p[:k]], self.plain[p[k:]]): self.plain[p] for p in long for k in range(1, len(p)) if p[:k] in self.plain and p[k:] in self.plain})

    def _pairs(self, pairs: dict[tuple[int, int], int]) -> None:
        """An open-addressed table of the pairs that merge, a quarter full."""
        self.bits = max(4, (4 * len(pairs)).bit_length())
        size = 1 << self.bits
        self.slot_key, self.slot_id = np.full(size, -1, np.int64), np.full(size, -1, np.int32)
        for (a, b), i in pairs.items():
            key = (a << 32) | b
            at = ((key * _C[0]) & _MASK) >> (64 - self.bits)
            while self.slot_key[at] >= 0:
                at = (at + 1) & (size - 1)
            self.slot_key[at], self.slot_id[at] = key, i

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols makes, -1 for none."""
        key = (a.astype(np.int64) << 32) | b.astype(np.int64)
        at = ((key.astype(np.uint64) * np.uint64(_C[0])) >> np.uint64(64 - self.bits)).astype(np.int64)
        out, size = np.full(len(key), -1, np.int32), len(self.slot_key)
        todo = np.flatnonzero((a >= 0) & (b >= 0))
        while len(todo):
            found = self.slot_key[at[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self.slot_id[at[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
            at[todo] = (at[todo] + 1) & (size - 1)
        return out

    def segment(self, words: list[str], keys: np.ndarray, dropout: float, made: list[bytes] | None = None) -> list[bytes]:
        """The ids of each word as packed 32-bit numbers. ``keys``: a 64-bit key per word.

        ``made`` gets the merges (start, mid, end) of each word of up to ROW_CHARS characters, packed alike.
        """
        out: list[bytes] = [b""] * len(words)
        lens = np.fromiter(map(len, words), np.int64, len(words))
        for low, high in ((0, 8), (8, 16), (16, ROW_CHARS)):
            some = np.flatnonzero((lens > low) & (lens <= high))
            if len(some):
                self._rows([words[i] for i in some], lens[some], keys[some], dropout, out, some, made)
        for i in np.flatnonzero(lens > ROW_CHARS):
            out[i] = self.agenda(words[i], int(keys[i]), dropout)
        for i in np.flatnonzero(lens == 1):
            if self.char_id[ord(words[i])] < 0:
                out[i] = np.array([self.byte_id[b] for b in words[i].encode()], np.int32).tobytes()
        return out

    def _rows(self, words, lens, keys, dropout, out, at, made=None) -> None:
        """All words at once: in each round, every word makes its best remaining merge."""
        n, width = len(words), int(lens.max()) + 1
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        row = np.repeat(np.arange(n), lens)
        col = np.arange(len(points)) - np.repeat(np.cumsum(lens) - lens, lens)
        sym = np.full((n, width), -1, np.int32)
        sym[row, col] = self.char_id[points]
        nxt = np.broadcast_to(np.arange(1, width + 1, dtype=np.int32), (n, width)).copy()
        prv = np.broadcast_to(np.arange(-1, width - 1, dtype=np.int32), (n, width)).copy()
        best = np.full((n, width), NONE, np.int32)
        into = np.full((n, width), -1, np.int32)
        ends = lens.astype(np.int32)

        def offer(r: np.ndarray, j: np.ndarray) -> None:
            """Put the merge of symbol j with the one after it on the agenda, unless it is skipped."""
            k = nxt[r, j]
            there = k < ends[r]
            k = np.minimum(k, width - 1)
            piece = np.where(there, self.merged(sym[r, j], sym[r, k]), -1)
            if dropout > 0:
                end = np.minimum(nxt[r, k], ends[r])
                piece = np.where(skipped(keys[r], j, k, end, dropout), -1, piece)
            into[r, j] = piece
            best[r, j] = np.where(piece >= 0, self.rank[piece], NONE)

        offer(row, col.astype(np.int32))
        rows, steps = np.arange(n), []
        while True:
            j = best[rows].argmin(axis=1).astype(np.int32)
            go = best[rows, j] < NONE
            rows, j = rows[go], j[go]
            if not len(rows):
                break
            k = nxt[rows, j]
            sym[rows, j], sym[rows, k], best[rows, k] = into[rows, j], -2, NONE
            after = nxt[rows, k]
            if made is not None:
                steps.append(np.stack([rows, j, k, np.minimum(after, ends[rows])], axis=1).astype(np.int32))
            nxt[rows, j] = after
            inner = after < width
            prv[rows[inner], after[inner]] = j[inner]
            offer(rows, j)
            left = prv[rows, j]
            has = left >= 0
            offer(rows[has], left[has])
        alive = (sym != -2) & (np.arange(width) < lens[:, None])
        flat = sym[alive].astype(np.int32).tobytes()
        stops = np.cumsum(alive.sum(axis=1)) * 4
        start = 0
        for i, stop in zip(at.tolist(), stops.tolist(), strict=True):
            out[i] = flat[start:stop]
            start = stop
        if made is not None and steps:
            merges = np.concatenate(steps)
            merges = merges[np.argsort(merges[:, 0], kind="stable")]
            stops, raw, start = np.cumsum(np.bincount(merges[:, 0], minlength=n)) * 12, np.ascontiguousarray(merges[:, 1:]).tobytes(), 0
            for i, stop in zip(at.tolist(), stops.tolist(), strict=True):
                made[i] = raw[start:stop]
                start = stop

    def agenda(self, word: str, key: int, dropout: float) -> bytes:
        """One word by a queue of candidate merges, best rank and then leftmost first."""
        points = np.frombuffer(word.encode("utf-32-le"), np.uint32)
        sym = self.char_id[points].tolist()
        n = len(sym)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[int, int, int, int, int]] = []
        keys = np.array([key], np.uint64)

        def offer(some: list[tuple[int, int]]) -> None:
            some = [(i, k) for i, k in some if i >= 0 and k < n]
            if not some:
                return
            i, k = np.array([x[0] for x in some]), np.array([x[1] for x in some])
            piece = self.merged(np.array([sym[x] for x in i]), np.array([sym[x] for x in k]))
            end = np.array([nxt[x] for x in k])
            if dropout > 0:
                piece = np.where(skipped(keys, i, k, end, dropout), -1, piece)
            for a, b, p, e in zip(i.tolist(), k.tolist(), piece.tolist(), end.tolist(), strict=True):
                if p >= 0:
                    heapq.heappush(queue, (int(self.rank[p]), a, b, e, p))

        offer([(i, i + 1) for i in range(n - 1)])
        while queue:
            _, i, k, end, piece = heapq.heappop(queue)
            if sym[i] == -2 or sym[k] == -2 or nxt[i] != k or nxt[k] != end:
                continue  # one of the two has changed since
            sym[i], sym[k], nxt[i] = piece, -2, end
            if end < n:
                prv[end] = i
            offer([(i, end), (prv[i], i)])
        out = []
        for s, c in zip(sym, word, strict=True):
            if s >= 0:
                out.append(s)
            elif s == -1:
                out.extend(self.byte_id[b] for b in c.encode())
        return np.array(out, np.int32).tobytes()


def skipped(keys: np.ndarray, start, mid, end, dropout: float) -> np.ndarray:
    """Whether the merge of [start, mid) and [mid, end) is skipped, by a hash keyed with the word's key."""
    u = np.uint64
    h = keys + np.asarray(start).astype(u) * u(_C[0]) + np.asarray(mid).astype(u) * u(_C[1]) + np.asarray(end).astype(u) * u(_C[2])
    return (mix(h) >> u(11)).astype(np.float64) * 2.0**-53 < dropout


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


@cache
def _memory(path: str) -> dict[str, tuple[bytes, bytes]]:
    return {}


def encode_texts(texts: list[str], doc_keys: np.ndarray, path: str, dropout: float, seed: int) -> list[bytes]:
    """The ids of each text as packed 32-bit numbers.

    With dropout every occurrence of a word has a key of its own. If that skips none of the merges that the word
    takes without dropout, these are its ids; else it is segmented by itself.
    """
    model = pieces(path)
    memory = _memory(path)
    if len(memory) > REMEMBERED:
        memory.clear()
    words = [model.words(" " + t) if t else [] for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    flat = [w for some in words for w in some]
    new = [w for w in dict.fromkeys(flat) if w not in memory and (dropout == 0 or len(w) <= ROW_CHARS)]
    if new:
        made = [b""] * len(new)
        plain = model.segment(new, np.zeros(len(new), np.uint64), 0.0, made)
        memory.update(zip(new, zip(plain, made, strict=True), strict=True))
    if dropout > 0:
        place = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
        salt = np.uint64(xxhash.xxh64_intdigest(str(seed)))
        keys = mix(np.repeat(mix(doc_keys ^ salt), counts) + place.astype(np.uint64) * np.uint64(_C[0]))
        known = [memory.get(w, (None, b"")) for w in flat]
        got = [ids for ids, _ in known]
        sizes = np.fromiter((len(m) for _, m in known), np.int64, len(known)) // 12
        merges = np.frombuffer(b"".join([m for _, m in known]), np.int32).reshape(-1, 3)
        row = np.repeat(np.arange(len(flat)), sizes)
        again = np.bincount(row[skipped(keys[row], *merges.T, dropout)], minlength=len(flat)) > 0
        again |= np.fromiter((ids is None for ids in got), bool, len(got))
        some = np.flatnonzero(again)
        for i, ids in zip(some.tolist(), model.segment([flat[i] for i in some], keys[some], dropout), strict=True):
            got[i] = ids
    else:
        got = [memory[w][0] for w in flat]
    out, at = [], 0
    for n in counts.tolist():
        out.append(b"".join(got[at : at + n]))
        at += n
    return out


def _with(df: DataFrame, name: str, kind: T.DataType) -> tuple[DataFrame, T.StructType]:
    """``df`` without a column of that name, and its schema with one."""
    df = df.drop(name)
    return df, T.StructType([*df.schema.fields, T.StructField(name, kind)])


def decode_ids(ids: np.ndarray, path: str) -> str:
    raw = b"".join(map(pieces(path).bytes.__getitem__, ids.tolist()))
    return raw[raw[:1] == b" " :].decode("utf-8", "replace")


def encode(
    docs: DataFrame, dropout: float = 0.1, seed: int = 1, path: str | None = None, text: str = "text", check: bool = False
) -> DataFrame:
    """``docs`` with ``ids``, the pieces of each text as an array of ints.

    Merges are made best first; each candidate is skipped with probability ``dropout`` by a hash
    keyed with the seed, the document id, the word's place in the text and the candidate's place, so every occurrence
    is segmented on its own, and the same call gives the same ids on any layout. Without dropout the ids are those of the library
    that made the vocabulary, except that U+2581 in a text goes as bytes: decoding is lossless.

    With ``check`` the ids are decoded in the same task, and ``lossless`` says whether that gives the text.

    Null and empty texts have no ids. Rows are independent: repeated rows get the same ids. Other
    columns stay; those named ids or lossless are replaced.
    """
    path = path or model_path()
    docs, schema = _with(docs.drop("lossless"), "ids", T.ArrayType(T.IntegerType(), False))
    if check:
        schema = T.StructType([*schema.fields, T.StructField("lossless", T.BooleanType())])
    key = "_key"
    while key in docs.columns:
        key += "_"
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("string")) if "doc_id" in docs.columns else F.xxhash64(text))

    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            _, offsets = strings(whole.column(text))
            for i, j in slices(offsets, STEP_BYTES):
                batch = whole.slice(i, j - i)
                texts = [t or "" for t in batch.column(text).to_pylist()]
                keys = batch.column(key).to_numpy(zero_copy_only=False).astype(np.uint64)
                packed = encode_texts(texts, keys, path, dropout, seed)
                lens = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
                values = pa.array(np.frombuffer(b"".join(packed), np.int32))
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)), values)
                cols, heads = [*(batch.column(c) for c in names), ids], [*names, "ids"]
                if check:
                    same = [decode_ids(np.frombuffer(p, np.int32), path) == t for p, t in zip(packed, texts, strict=True)]
                    cols, heads = [*cols, pa.array(same, pa.bool_())], [*heads, "lossless"]
                yield pa.RecordBatch.from_arrays(cols, names=heads)

    return keyed.mapInArrow(run, schema)


def decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with ``decoded``, the text that ``ids`` stand for; null for null ids.

    The blank that encoding puts before a text is taken away. Byte pieces
    that make no valid UTF-8 give U+FFFD.
    """
    path = path or model_path()
    docs, schema = _with(docs, "decoded", T.StringType())
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            out = [decode_ids(x.values.to_numpy(zero_copy_only=False), path) if x.is_valid else None for x in ids]
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(out, pa.string())], names=[*names, "decoded"])

    return docs.mapInArrow(run, schema)
