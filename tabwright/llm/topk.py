"""Exact top-k search: products of query and shard tiles, selection per tile, tree merging."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.session import settle

#: Bytes of query vectors that one round broadcasts.
QUERY_BYTES = 16 << 20
#: Queries and candidates of one tile.
TILE_QUERIES, TILE_ROWS = 512, 4096
#: Partial lists that one merge takes.
FAN_IN = 8
LONG = 2**63 - 1
OUT = pa.schema([("query_id", pa.int64()), ("dim", pa.int32()), ("part", pa.int32()), ("neg", pa.list_(pa.int64())), ("vec", pa.list_(pa.int64()))])


def exact_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of ``q`` and ``c`` (whole numbers, as doubles).

    Floating products are exact while every partial sum stays below 2**53. Beyond
    that whole numbers of any length are used, and scores out of range take the nearest long.
    """
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if most < 2.0**53:
        return (q @ c.T).astype(np.int64)
    big = lambda m: np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
    return np.clip(big(q) @ big(c).T, -LONG, LONG).astype(np.int64)


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per row the k highest scores, ties to smaller ids; ``ids`` has a row per row or one for all."""
    out = []
    ids = np.broadcast_to(ids, scores.shape)
    if scores.shape[1] > k:
        bar = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    for i, s in enumerate(scores):
        keep = np.flatnonzero(s >= bar[i]) if scores.shape[1] > k else np.arange(len(s))
        order = np.lexsort((ids[i, keep], -s[keep]))[:k]
        out.append((s[keep][order], ids[i, keep][order]))
    return out


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, dim, v): components floored after scaling by 1024; vectors with a null or non-finite component are left out."""
    scaled: Column = F.transform(F.col(vector_col), lambda x: F.floor(F.lit(1024.0) * x.cast("double")))
    whole = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    safe = F.forall(vector_col, lambda x: F.abs(x.cast("double")) < 2.0**52)
    # floor() gives a long; larger components are whole already
    wide = F.transform(F.col(vector_col), lambda x: F.lit(1024.0) * x.cast("double"))
    v = F.when(safe, F.transform(scaled, lambda x: x.cast("double"))).otherwise(wide)
    return vectors.filter(F.col(vector_col).isNotNull() & F.col(id_col).isNotNull() & whole).select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.size(vector_col).alias("dim"), v.alias("v")
    )


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def _tiles(queries: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    """mapInArrow function: the best k of a partition for every query, built tile by tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        best: dict[int, list] = {d: [None] * len(ids) for d, (ids, _) in queries.items()}
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_ROWS):
                tile = batch.slice(at, TILE_ROWS)
                dims = tile.column("dim").to_numpy()
                for d in np.unique(dims):
                    if d not in queries:
                        continue
                    rows = pa.array(np.flatnonzero(dims == d))
                    ids, c = tile.column("vec_id").take(rows).to_numpy(), _matrix(tile.column("v").take(rows), int(d))
                    qids, q = queries[d]
                    for lo in range(0, len(qids), TILE_QUERIES):
                        some = slice(lo, lo + TILE_QUERIES)
                        scores = exact_scores(q[some], c)
                        # a query is no candidate of its own: one more is selected and it is taken out
                        for i, (s, v) in enumerate(best_of(scores, ids, k + 1), lo):
                            other = v != qids[i]
                            if not other.all() and len(s) == k + 1 and (~other).sum() > 1:
                                other = np.flatnonzero(ids != qids[i])
                                s, v = best_of(scores[i - lo : i - lo + 1, other], ids[other], k)[0]
                                other = slice(None)
                            s, v = s[other][:k], v[other][:k]
                            if best[d][i] is not None:
                                s, v = np.concatenate([best[d][i][0], s]), np.concatenate([best[d][i][1], v])
                                order = np.lexsort((v, -s))[:k]
                                s, v = s[order], v[order]
                            best[d][i] = (s, v)
        part = TaskContext.get().partitionId()
        for d, found in best.items():
            got = [(int(queries[d][0][i]), *b) for i, b in enumerate(found) if b is not None and len(b[0])]
            for lo in range(0, len(got), 10_000):
                some = got[lo : lo + 10_000]
                cols = [[g[0] for g in some], [d] * len(some), [part] * len(some), [-g[1] for g in some], [g[2] for g in some]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, OUT, strict=True)], schema=OUT)

    return run


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """The ``k`` highest integer inner products of each query over all other vectors: query_id, rank, vec_id, score.

    Both tables have an id and a vector; only vectors of equal length are compared.
    Queries are broadcast in rounds of ``query_bytes``; each round reads the candidates once,
    and a task keeps k rows per query. Partial lists are merged eight at a time.

    Vectors that are null or hold null, NaN or infinity take no part, nor do null ids. Empty vectors are of
    length 0 and score 0 with each other. Every row whose id is the query's counts as the query itself;
    repeated candidates are listed as often as they occur. Ties go to smaller ids. Other
    columns are ignored, empty tables give none.
    """
    spark = vectors.sparkSession
    pool = usable(vectors, id_col, vector_col)
    asked = settle(usable(queries, id_col, vector_col).dropDuplicates(["vec_id", "dim"]), "queries")
    lists = None
    for chosen in _rounds(asked, query_bytes):
        held = spark.sparkContext.broadcast(chosen)
        part = pool.mapInArrow(_Round(held, k), "query_id bigint, dim int, part int, neg array<bigint>, vec array<bigint>")
        part = settle(part, "partial")
        lists = part if lists is None else lists.unionByName(part)
        held.unpersist()
    if lists is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    pairs = F.arrays_zip("neg", "vec")
    lists = lists.select("query_id", "dim", "part", pairs.alias("best"))
    width = 1 + (lists.agg(F.max("part")).first()[0] or 0)
    while True:
        width = -(-width // FAN_IN)
        merged = F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k)
        lists = lists.groupBy("query_id", "dim", F.floor(F.col("part") / FAN_IN).cast("int").alias("part")).agg(merged.alias("best"))
        if width <= 1:
            break
    out = lists.select("query_id", F.posexplode("best").alias("pos", "b"))
    return out.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("b.vec").alias("vec_id"), (-F.col("b.neg")).alias("score"))


class _Round:
    def __init__(self, held, k: int):
        self.held, self.k = held, k

    def __call__(self, batches):
        return _tiles(self.held.value, self.k)(batches)


def _rounds(asked: DataFrame, limit: int) -> Iterator[dict[int, tuple[np.ndarray, np.ndarray]]]:
    """The queries, at most ``limit`` bytes of them at a time, as matrices by dimension."""
    size = asked.agg(F.sum(F.lit(8) * F.col("dim") + 8)).first()[0]
    if size is None:
        return
    n = -(-int(size) // (limit // 2))  # by hash, so a round may get more than its share
    for i in range(n):
        part = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(n)) == i) if n > 1 else asked
        found = part.orderBy("dim", "vec_id").toArrow()
        if found.num_rows:
            dims = found.column("dim").to_numpy()
            out = {}
            for d in np.unique(dims):
                some = found.take(pa.array(np.flatnonzero(dims == d))).combine_chunks()
                out[int(d)] = (some.column("vec_id").to_numpy(), _matrix(some.column("v").combine_chunks(), int(d)))
            yield out
