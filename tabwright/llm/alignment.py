"""Alignment of two tokenizers: which tokens of one stand where which tokens of the other do."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.base import slices, strings, text_of
from tabwright.operators.joins import lookup
from tabwright.session import settle

TOKENIZERS = "/opt/tokenizers"
BYTE_VOCABULARY, PIECE_MODEL = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Fixed value: how the byte-level vocabulary splits a text before it merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of text whose documents make one chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 18
#: Pairs of different ids that are spelled out at a time.
BLOCK = 1 << 22
#: A pair is one number: the id of A times this plus the id of B.
SPAN = 1 << 20
#: Vectors of counts that one task adds up before the last sum.
FAN = 64
#: Chunks of a file of the chunk table; a reader takes up to 4,096 rows of a file at a time.
FILE_CHUNKS = 64


@dataclass(frozen=True)
class Side:
    """A tokenizer with the bytes of each of its ids."""

    encode: Callable[[list[str]], list]
    spelled: tuple[bytes, ...]

    @property
    def lengths(self) -> np.ndarray:
        return np.array([len(b) for b in self.spelled], np.int64)


def byte_level(folder: str) -> Side:
    """The byte-level vocabulary; it splits and merges as its file says, and knows no special tokens."""
    import tiktoken

    with open(f"{folder}/{BYTE_VOCABULARY}", encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocabulary = model["vocab"]
    merged = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
    if merged != sorted(merged):
        raise ValueError(f"the merges of {BYTE_VOCABULARY} are not in the order of their ids")
    # printable bytes stand for themselves, the others in order for the code points from 256 on
    own = [b for b in range(256) if 33 <= b <= 126 or (161 <= b and b != 173)]
    rest = [b for b in range(256) if b not in own]
    byte_of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items()}
    spelled = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        spelled[i] = token
    coder = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return Side(lambda texts: [coder.encode_ordinary(" " + t) for t in texts], tuple(spelled))


def pieces(folder: str) -> Side:
    """The piece model; it puts a blank before the text by itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{PIECE_MODEL}")
    spelled = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        spelled.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
    return Side(lambda texts: model.encode(texts, num_threads=1), tuple(spelled))


@lru_cache(maxsize=2)
def sides(folder: str) -> tuple[Side, Side]:
    return byte_level(folder), pieces(folder)


@lru_cache(maxsize=2)
def identity(folder: str) -> np.ndarray:
    """For each id of A the id of B with the same bytes, the last of several; -1 where there is none."""
    a, b = sides(folder)
    by_bytes = {spelling: i for i, spelling in enumerate(b.spelled) if spelling}
    return np.array([by_bytes.get(spelling, -1) for spelling in a.spelled], np.int64)


@lru_cache(maxsize=4)
def _decimals(top: int) -> np.ndarray:
    """Ids below ``top`` in decimal, one a row, right-aligned after zero bytes."""
    width = len(str(top))
    digits = np.zeros((top, width), np.uint8)
    ids = np.arange(top)
    for place in range(width):
        power = 10**place
        digits[:, width - 1 - place] = np.where((ids >= power) | (place == 0), ids // power % 10 + 48, 0)
    return digits


@dataclass
class Groups:
    """Tokens of several texts, cut where tokens of both sides end."""

    a: np.ndarray
    b: np.ndarray
    #: group of each token
    ga: np.ndarray
    gb: np.ndarray
    #: document of each group
    doc: np.ndarray


def grouped(a: np.ndarray, b: np.ndarray, la: np.ndarray, lb: np.ndarray, sizes: np.ndarray) -> Groups:
    """``la`` and ``lb``: bytes of each token; ``sizes``: bytes of each text, equal for both sides."""
    ea, eb = np.cumsum(la), np.cumsum(lb)
    ends = np.intersect1d(ea, eb, assume_unique=True)
    return Groups(a, b, np.searchsorted(ends, ea), np.searchsorted(ends, eb), np.searchsorted(np.cumsum(sizes), ends))


def listed(g: Groups, n_docs: int) -> list[bytes]:
    """Each document's groups as text: ids of A by commas, a bar, ids of B by commas; groups by semicolons."""
    n, m, groups = len(g.a), len(g.b), len(g.doc)
    na, nb = np.bincount(g.ga, minlength=groups), np.bincount(g.gb, minlength=groups)
    place_a = np.arange(n) + (np.cumsum(nb) - nb)[g.ga]
    place_b = np.arange(m) + np.cumsum(na)[g.gb]
    ids = np.empty(n + m, np.int64)
    ids[place_a], ids[place_b] = g.a, g.b
    mark = np.full(n + m, ord(","), np.uint8)
    last_a, last_b = np.cumsum(na) - 1, np.cumsum(nb) - 1
    mark[place_a[last_a]], mark[place_b[last_b]] = ord("|"), ord(";")
    table = _decimals(SPAN // 10)
    chars = np.column_stack([table[ids], mark]).ravel()
    there = chars != 0
    per_token = there.reshape(n + m, -1).sum(axis=1)
    doc = np.empty(n + m, np.int64)
    doc[place_a], doc[place_b] = g.doc[g.ga], g.doc[g.gb]
    cut = np.append(0, np.cumsum(np.bincount(doc, per_token, minlength=n_docs).astype(np.int64)))
    whole = chars[there].tobytes()
    return [whole[x : max(x, y - 1)] for x, y in zip(cut[:-1], cut[1:], strict=True)]


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts


def _per_group(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """group, id and number of the different ids of each group."""
    keys, n = _summed(group * SPAN + ids, np.ones(len(ids), np.int64))
    return keys // SPAN, keys % SPAN, n


def links(g: Groups, same: np.ndarray, pack: np.ndarray) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...], np.ndarray]:
    """(doc, id of A, links) of pairs with the same bytes, (doc, pair, links) of all others, and links per group.

    Groups of one token a side with the same bytes go straight to the first; of the others the different ids of
    each side meet, with the products of how often they occur. ``pack`` numbers the documents.
    """
    groups = len(g.doc)
    na, nb = np.bincount(g.ga, minlength=groups), np.bincount(g.gb, minlength=groups)
    first_a, first_b = np.cumsum(na) - na, np.cumsum(nb) - nb
    single = (na == 1) & (nb == 1)
    at = np.flatnonzero(single)
    a, b = g.a[first_a[at]], g.b[first_b[at]]
    exact = same[a] == b
    plain = pack[g.doc[at[exact]]] * SPAN + a[exact]
    odd = np.ones(groups, bool)
    odd[at[exact]] = False
    sa, sb = odd[g.ga], odd[g.gb]
    xg, xa, xn = _per_group(g.ga[sa], g.a[sa])
    yg, yb, yn = _per_group(g.gb[sb], g.b[sb])
    of = np.bincount(yg, minlength=groups)
    begin = (np.cumsum(of) - of)[xg]
    more_keys, more_n = [plain], [np.ones(len(plain), np.int64)]
    pair_keys, pair_docs, pair_n = [], [], []
    width = of[xg]
    edge = np.cumsum(width)
    i = 0
    while i < len(xg):  # a block of ids of A at a time, with all ids of B that they meet
        j = max(i + 1, int(np.searchsorted(edge, (edge[i - 1] if i else 0) + BLOCK, "right")))
        x = np.repeat(np.arange(i, j), width[i:j])
        y = begin[x] + np.arange(len(x)) - np.repeat(np.cumsum(width[i:j]) - width[i:j], width[i:j])
        doc, n = pack[g.doc[xg[x]]], xn[x] * yn[y]
        alike = same[xa[x]] == yb[y]
        more_keys.append(doc[alike] * SPAN + xa[x][alike])
        more_n.append(n[alike])
        pair = xa[x][~alike] * SPAN + yb[y][~alike]
        keep, inverse = np.unique(pair, return_inverse=True)
        keys, total = _summed(doc[~alike] * len(keep) + inverse, n[~alike])
        pair_docs.append(keys // max(1, len(keep)))
        pair_keys.append(keep[keys % max(1, len(keep))])
        pair_n.append(total)
        i = j
    keys, total = _summed(np.concatenate(more_keys), np.concatenate(more_n))
    exact_rows = keys // SPAN, keys % SPAN, total
    docs, pairs, n = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (pair_docs, pair_keys, pair_n))
    if len(pair_keys) > 1:
        keep, inverse = np.unique(pairs, return_inverse=True)
        keys, n = _summed(docs * len(keep) + inverse, n)
        docs, pairs = keys // len(keep), keep[keys % len(keep)]
    return exact_rows, (docs, pairs, n), na * nb


_LONG, _INT = T.LongType(), T.IntegerType()
#: Of each document of a chunk, in order; then the chunk's pairs.
_DOCS = {"n_a": _LONG, "n_b": _LONG, "n_groups": _LONG, "n_links": _LONG, "sha": T.StringType()}
_PAIRS = {"pair": _LONG, "docs": _INT}


def _packed(arrays: Iterable[np.ndarray]) -> bytes:
    """Whole numbers from 0: per array its width and length, then its numbers in as few bytes each as the largest needs; compressed."""
    parts = []
    for v in arrays:
        kind = np.min_scalar_type(int(v.max(initial=0)))
        parts += [np.array([kind.itemsize, len(v)], np.int64).tobytes(), v.astype(kind).tobytes()]
    body = b"".join(parts)
    return len(body).to_bytes(8, "little") + pa.compress(body, "zstd", asbytes=True)


def _unpacked(data: bytes) -> list[np.ndarray]:
    body = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    out, at = [], 0
    while at < len(body):
        width, n = np.frombuffer(body, np.int64, 2, at).tolist()
        out.append(np.frombuffer(body, f"u{width}", n, at + 16).astype(np.int64))
        at += 16 + width * n
    return out


def _chunk_schema(doc_id: T.StructField) -> T.StructType:
    """A chunk; ``entries`` has numbers that Spark only carries, packed: six arrays of entries, and the id of A of each pair."""
    out = T.StructType().add("chunk", _LONG).add("doc_id", T.ArrayType(doc_id.dataType))
    for c, t in (_DOCS | _PAIRS).items():
        out = out.add(c, T.ArrayType(t, False))
    return out.add("entries", T.BinaryType()).add("counts", T.BinaryType())


def _align(texts: list[str], folder: str) -> tuple[dict[str, list], dict[str, np.ndarray], list[np.ndarray]]:
    """The columns of one chunk: of its documents, and its pairs; then its entries.

    Entries are (document, id of A, links) of pairs with the same bytes and (document, place of the pair, links) of all others.
    """
    side_a, side_b = sides(folder)
    raw = [t.encode() for t in texts]
    ids_a = side_a.encode(texts)
    ids_b = side_b.encode(texts)

    def spelled(ids: list[int], table: tuple[bytes, ...]) -> bytes:
        return b"".join(itemgetter(*ids)(table)) if len(ids) > 1 else b"".join(table[i] for i in ids)

    good = [k for k, t in enumerate(raw) if t and all(spelled(v[k], s.spelled) == b" " + t for v, s in ((ids_a, side_a), (ids_b, side_b)))]
    n = len(texts)
    docs = {c: [0] * n for c in ("n_a", "n_b", "n_groups", "n_links")} | {"sha": [""] * n}
    if not good:
        return docs, {c: np.zeros(0, np.int64) for c in _PAIRS}, [np.zeros(0, np.int64)] * 6
    a = np.concatenate([np.array(ids_a[k], np.int64) for k in good])
    b = np.concatenate([np.array(ids_b[k], np.int64) for k in good])
    sizes = np.array([len(raw[k]) + 1 for k in good])
    g = grouped(a, b, side_a.lengths[a], side_b.lengths[b], sizes)
    same, other, per_group = links(g, identity(folder), np.array(good))
    na = np.bincount(g.doc[g.ga], minlength=len(good))
    nb = np.bincount(g.doc[g.gb], minlength=len(good))
    ng = np.bincount(g.doc, minlength=len(good))
    total = np.add.reduceat(per_group, np.cumsum(ng) - ng)
    for at, (k, text) in enumerate(zip(good, listed(g, len(good)), strict=True)):
        docs["n_a"][k], docs["n_b"][k], docs["n_groups"][k], docs["n_links"][k] = int(na[at]), int(nb[at]), int(ng[at]), int(total[at])
        docs["sha"][k] = hashlib.sha256(text).hexdigest()
    pairs, place = np.unique(other[1], return_inverse=True)
    return docs, {"pair": pairs, "docs": np.bincount(place, minlength=len(pairs))}, [*same, other[0], place, other[2]]


def _chunks(schema: T.StructType, folder: str):
    """A mapInArrow function: a row per chunk of documents, and one row per task with its vector of counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        number = TaskContext.get().partitionId() << 32
        vector = np.zeros(len(identity(folder)), np.int64)

        def row(values: dict) -> pa.RecordBatch:
            cols = [pa.array([values.get(f.name)], f.type) for f in arrow]
            return pa.RecordBatch.from_arrays(cols, schema=arrow)

        for batch in batches:
            _, offsets = strings(batch.column("text"))
            for i, j in slices(offsets, CHUNK_BYTES):
                docs, found, entries = _align(batch.column("text").slice(i, j - i).to_pylist(), folder)
                np.add.at(vector, entries[1], 1)
                ids = {"chunk": number, "doc_id": batch.column("doc_id").slice(i, j - i).to_pylist()}
                yield row(ids | docs | found | {"entries": _packed([*entries, found["pair"] // SPAN])})
                number += 1
        if vector.any():
            yield row({"chunk": -1 - TaskContext.get().partitionId(), "counts": vector.tobytes()})

    return run


def _total(vectors: DataFrame, width: int) -> np.ndarray:
    """The sum of the vectors of all tasks, in two steps."""

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(width, np.int64)
        for v in table.column("counts"):
            total += np.frombuffer(v.as_py(), np.int64)
        return pa.table({"counts": pa.array([total.tobytes()], pa.binary())})

    some = vectors.select("counts", F.pmod("chunk", F.lit(FAN)).alias("_part")).groupBy("_part").applyInArrow(add, "counts binary")
    return sum((np.frombuffer(r["counts"], np.int64) for r in some.collect()), np.zeros(width, np.int64))


@dataclass(frozen=True)
class Alignment:
    """What ``align`` finds: chunks of documents, counts of pairs with the same bytes by id of A, counts of other pairs."""

    chunks: DataFrame
    identity_counts: np.ndarray
    pairs: DataFrame
    folder: str

    def pair_counts(self) -> DataFrame:
        """All linked pairs: a, b, n (documents that hold the pair linked)."""
        spark, same = self.chunks.sparkSession, identity(self.folder)
        rows = [(int(a), int(same[a]), int(self.identity_counts[a])) for a in np.flatnonzero(self.identity_counts)]
        other = self.pairs.select((F.col("pair") / SPAN).cast("bigint").alias("a"), (F.col("pair") % SPAN).alias("b"), "n")
        return spark.createDataFrame(rows, "a bigint, b bigint, n bigint").unionByName(other)


def align(docs: DataFrame, folder: str = TOKENIZERS) -> Alignment:
    """Encode every text with both tokenizers, cut it where both end a token, and count the linked pairs.

    Tokens of a group are linked with each other. A pair whose two ids spell the same bytes is counted in a vector as long
    as the vocabulary, which each task adds up for its documents; only other pairs, from groups that are not one to
    one, go through a shuffle, once per chunk of about CHUNK_BYTES with the number of its documents. In a group
    the different ids meet, not their occurrences.

    Texts that are null, empty or not spelled by their tokens hold no pair. Repeated rows count each; null and repeated ids
    are rows like any other. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id"), text_of().alias("text"))
    schema = _chunk_schema(docs.schema["doc_id"])
    found = settle(rows.mapInArrow(_chunks(schema, folder), schema), "chunks", FILE_CHUNKS)
    counts = _total(found.filter("chunk < 0"), len(identity(folder)))
    chunks = found.filter("chunk >= 0").drop("counts")
    each = chunks.select(F.explode(F.arrays_zip("pair", "docs")).alias("p")).select("p.pair", "p.docs")
    pairs = settle(each.groupBy("pair").agg(F.sum("docs").alias("n"), F.count(F.lit(1)).alias("chunks")), "pairs")
    return Alignment(chunks, counts, pairs, folder)


def scored(found: Alignment) -> DataFrame:
    """Per document of ``align``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_best`` are the links whose pair is in as many documents as any pair of its id of A; ``count_sum`` adds the
    counts up over the links. Each chunk gets the counts of its own pairs, and no others; a task holds one chunk at a time.
    """
    best = found.identity_counts.copy()
    # at most one row per id of A
    for r in found.pairs.groupBy((F.col("pair") / SPAN).cast("bigint").alias("a")).agg(F.max("n").alias("n")).collect():
        best[r["a"]] = max(best[r["a"]], r["n"])
    same_counts = found.identity_counts
    each = found.chunks.select("chunk", F.posexplode("pair").alias("at", "pair"))
    known = lookup(each, found.pairs, ["pair"], "chunks", "chunk").select(F.col("chunk").alias("of"), "at", "n")
    rows = found.chunks.select("chunk", "doc_id", *_DOCS, "entries")
    doc_id = found.chunks.schema["doc_id"].dataType.elementType
    schema = T.StructType().add("doc_id", doc_id)
    for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"):
        schema = schema.add(c, _LONG)
    schema = schema.add("groups_sha256", T.StringType())

    def run(chunk: pa.Table, known: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        row = chunk.combine_chunks().to_batches()[0]
        of = lambda c: row.column(c)[0].values
        n = len(of("doc_id"))
        sums, tops = np.zeros(n, np.int64), np.zeros(n, np.int64)
        doc, a, times, pair_doc, at, pair_times, owner = _unpacked(row.column("entries")[0].as_py())
        np.add.at(sums, doc, same_counts[a] * times)
        np.add.at(tops, doc, (same_counts[a] == best[a]) * times)
        if len(owner):
            count = np.empty(len(owner), np.int64)
            count[known.column("at").to_numpy()] = known.column("n").to_numpy()
            np.add.at(sums, pair_doc, count[at] * pair_times)
            np.add.at(tops, pair_doc, (count == best[owner])[at] * pair_times)
        cols = [of("doc_id"), *[of(c) for c in ("n_a", "n_b", "n_groups", "n_links")], pa.array(tops), pa.array(sums), of("sha")]
        return pa.table([c.cast(f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    return rows.groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(run, schema)


__all__ = ["align", "scored"]
