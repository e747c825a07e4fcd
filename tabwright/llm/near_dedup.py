"""Near-duplicate documents by bands of weighted MinHash signatures, verified on the multisets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.base import BROADCAST_ROWS, checked_broadcast, keep_rows, lowered, mix, per_slice, slices, strings, text_of, word_hashes, word_starts
from tabwright.llm.graph import components
from tabwright.llm.weighted_minhash import bands, occurrences, shingles, signatures
from tabwright.operators.joins import lookup
from tabwright.session import settle

WORDS = 5
THRESHOLD = 0.8
#: A pair of similarity 0.8 shares no band with probability (1 - 0.8**5)**36, less than one in a million.
BANDS, ROWS = 36, 5
#: A pair whose signatures agree in a smaller share of components is not compared further: at
#: similarity 0.8 that is five standard deviations off.
LEAST_AGREEMENT = 0.65
#: Members of a bucket that one side of a tile of comparisons takes.
TILE = 1024
#: Larger buckets are compared exactly in their tiles; of smaller ones the likely pairs are joined to their multisets.
FEW = 32
#: What a null id counts as.
LEAST = -(2**63)
_U = np.uint64


def _prints(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each row's sequence of words, and its words."""
    low = lowered(data)
    starts, counts = word_starts(low, offsets)
    w = word_hashes(low, starts)
    first = np.cumsum(counts) - counts
    place = (np.arange(len(w)) - np.repeat(first, counts)).astype(_U)
    cut, prints = np.append(first, len(w)), []
    for salt in (0x2545F4914F6CDD1D, 0x9E6C63D0876A9A99):
        sums = np.append(_U(0), np.cumsum(mix(w * _U(salt) + place * _U(0xD6E8FEB86659FD93) + _U(salt)), dtype=_U))
        prints.append((sums[cut[1:]] - sums[cut[:-1]] + counts.astype(_U) * _U(salt)).astype(np.int64))
    return *prints, counts.astype(np.int64)


def _sketch(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    """The text's prints, band keys and signature (8 bits of each component) for each row."""
    node, check, n_words = _prints(data, offsets)
    sigs = signatures(*shingles(data, offsets, WORDS), batch.num_rows, BANDS * ROWS)
    keys = bands(sigs, ROWS).astype(np.int64)
    lists = pa.ListArray.from_arrays(np.arange(0, (len(keys) + 1) * BANDS, BANDS, dtype=np.int32), pa.array(keys.ravel()))
    packed = pa.array([k.tobytes() for k in keys], pa.binary())
    short = [s.tobytes() for s in sigs.astype(np.uint8)]
    cols = [batch.column("doc_id"), pa.array(node), pa.array(check), pa.array(n_words), lists, packed, pa.array(short, pa.binary())]
    return pa.RecordBatch.from_arrays(cols, names=["doc_id", "node", "check", "n_words", "bands", "packed", "sig"])


def _multisets(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    keys, r = occurrences(*shingles(data, offsets, WORDS))
    keys = keys[np.lexsort((keys, r))]
    cut = np.searchsorted(r, np.arange(batch.num_rows + 1))
    sets = [keys[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(_prints(data, offsets)[0]), pa.array(sets, pa.binary())], names=["node", "items"])


def _nodes(texts: pa.Array) -> pa.Array:
    """The first print of each text, by which it is a node."""
    data, offsets = strings(texts)
    parts = [_prints(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])[0] for i, j in slices(offsets)]
    return pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64))


def overlap(a: bytes, b: bytes) -> float:
    """Weighted Jaccard similarity of two packed multisets."""
    x, y = np.frombuffer(a, _U), np.frombuffer(b, _U)
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    both = np.sort(np.concatenate([x, y]), kind="stable")
    same = int((both[1:] == both[:-1]).sum())
    return same / (len(x) + len(y) - same)


def _verified(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with their similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("x"), batch.column("y"), strict=True)
            sim = [overlap(x.as_py(), y.as_py()) for x, y in both]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(sim, pa.float64())], names=["a", "b", "sim"])

    x = items.select(F.col("node").alias("a"), F.col("items").alias("x"))
    y = items.select(F.col("node").alias("b"), F.col("items").alias("y"))
    return pairs.join(y, "b").join(x, "a").select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint, sim double")


def _tiles(members: DataFrame, sigs: DataFrame, threshold: float | None = None) -> DataFrame:
    """Pairs (a, b) of one bucket but of different components whose signatures agree often enough.

    ``members`` are (key, node, root, n), n the members of the bucket; ``sigs`` (node, sig, bands) the signature and the keys of
    all bands of a node. A bucket is cut into blocks of about TILE members; each pair of blocks is a group
    of its own, so that a large bucket spreads out. A pair that shares several bands is looked at in the
    first of them only. With ``threshold`` (``sigs`` then has the multisets too) pairs are compared
    exactly in their tile, and a tile returns just enough links to join what it finds to be
    joined: fewer than it has members.
    """
    carried = [c for c in sigs.columns if c != "node"]
    rows = members.withColumn("blocks", F.ceil(F.col("n") / TILE).cast("int")).join(sigs, "node")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = rows.withColumn("block", block).select("key", "node", "root", *carried, "block", other)
    rows = rows.select("key", "node", "root", *carried, "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("block", "ascending"), ("node", "ascending")])
        ids, roots, block = (table.column(c).to_numpy() for c in ("node", "root", "block"))
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(len(ids), -1)
        items = table.column("items").to_pylist() if threshold is not None else []
        keys = np.frombuffer(b"".join(table.column("bands").to_pylist()), np.int64).reshape(len(ids), -1)
        band = int((keys[0] == table.column("key")[0].as_py()).argmax())
        left = np.flatnonzero(block == block[0])
        same_block = len(left) == len(ids)
        joined = {int(r): int(r) for r in np.unique(roots)}

        def top(r: int) -> int:
            while joined[r] != r:
                joined[r] = joined[joined[r]]
                r = joined[r]
            return r

        a, b = [], []
        for p in left.tolist():
            rest = np.arange(p + 1, len(ids)) if same_block else np.arange(len(left), len(ids))
            rest = rest[roots[rest] != roots[p]]
            if not len(rest):
                continue
            rest = rest[(keys[rest] == keys[p]).argmax(axis=1) == band]
            rest = rest[(sig[rest] == sig[p]).mean(axis=1) >= LEAST_AGREEMENT]
            for q in rest.tolist():
                if threshold is not None:
                    x, y = top(int(roots[p])), top(int(roots[q]))
                    if x == y or overlap(items[p], items[q]) < threshold:
                        continue
                    joined[max(x, y)] = min(x, y)
                a.append(min(ids[p], ids[q]))
                b.append(max(ids[p], ids[q]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("key", "i", "j").applyInArrow(run, "a bigint, b bigint")


def _of_key(rows: DataFrame, table: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` with the columns of a settled ``table`` (one row per key, ``size`` rows of ``rows`` at most have it); others go."""
    if table.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table), key)
    return lookup(rows, table, [key], size, rows.columns[0] if rows.columns[0] != key else rows.columns[1]).filter(F.col(size).isNotNull())


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, kept.

    Documents are multisets of their runs of five words (A-Z lower-cased; a shorter text is one run). Two
    different texts are linked if the weighted Jaccard similarity of their multisets is
    ``threshold`` or more; a class is what links join, and its id the smallest doc_id, which is kept.

    Texts with the same words are one node. Nodes that
    share a band of their signatures meet in a bucket. First every member is compared with the one of its
    bucket that meets most others, which joins most of a group of near copies to its original by as many comparisons as it has members.
    Then members of a bucket that are still in different classes are compared with each other, by
    signature in tiles, and exactly where these are close. So every pair that shares a band is either joined by
    verified links or compared.

    Texts without words are copies of each other. Null ids are taken for the least long; of the classes
    that have one the first has that id, the others one from the text that is kept, with the sign bit set. An id with several texts is a document per text: of a class,
    the smallest id and then the smallest node is kept. Repeated rows are copies. Other columns are ignored; an empty table gives no rows.
    """
    return _placed(docs, threshold).drop("node")


def _placed(docs: DataFrame, threshold: float) -> DataFrame:
    """``classes`` with the node of each row's text."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LEAST)).alias("doc_id"), text_of().alias("text"))
    sketch = rows.mapInArrow(per_slice(_sketch), "doc_id bigint, node bigint, check bigint, n_words bigint, bands array<bigint>, packed binary, sig binary")
    sketch = settle(sketch, "sketch")
    texts = settle(sketch.groupBy("node").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")), "texts")

    each = sketch.filter("n_words > 0").select("node", F.explode("bands").alias("key"))
    shared = each.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last"), F.count(F.lit(1)).alias("rows")).filter("first < last")
    shared = settle(shared.select("key", "rows"), "buckets")
    members = settle(_of_key(each, shared, "key", "rows").select("key", "node").distinct(), "members")
    sizes = settle(members.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "sizes")
    met = _of_key(members, sizes, "key", "n").groupBy("node").agg(F.sum("n").alias("met"))
    met = settle(met, "met")
    first = members.join(checked_broadcast(met), "node").groupBy("key").agg(F.max_by("node", F.struct("met", "node")).alias("pivot"), F.count(F.lit(1)).alias("n"))
    first = settle(first, "pivots")
    involved = settle(members.select("node").distinct().join(texts, "node").select("node", "rep"), "involved")
    sources = keep_rows(rows, involved.select(F.col("rep").alias("doc_id")), "left_semi")
    items = sources.mapInArrow(per_slice(_multisets), "node bigint, items binary")
    items = settle(items.join(checked_broadcast(involved.select("node")), "node", "left_semi"), "items")
    if items.count() > involved.count():  # repeated ids
        items = settle(items.dropDuplicates(["node"]), "items")

    pairs = _of_key(members, first, "key", "n").filter("node <> pivot").select(F.least("pivot", "node").alias("a"), F.greatest("pivot", "node").alias("b")).distinct()
    tried = settle(_verified(pairs, items), "tried")
    links = tried.filter(F.col("sim") >= threshold)
    roots = settle(components(links), "roots")
    placed = members.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    placed = settle(placed, "placed")
    apart = placed.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 < r1").select("key")
    apart = settle(apart, "apart")
    if not apart.isEmpty():
        sigs = settle(sketch.join(checked_broadcast(involved.select("node", F.col("rep").alias("doc_id"))), ["node", "doc_id"]).select("node", "sig", F.col("packed").alias("bands")), "sigs")
        sigs = sigs.dropDuplicates(["node"])
        left = _of_key(placed, settle(sizes.join(apart, "key"), "apart"), "key", "n")
        close = _tiles(left.filter(F.col("n") <= FEW), sigs).distinct()
        close = close.join(tried.select("a", "b"), ["a", "b"], "left_anti")
        found = settle(_verified(close, items).filter(F.col("sim") >= threshold).select("a", "b"), "tried")
        large = left.filter(F.col("n") > FEW)
        more = found.unionByName(settle(_tiles(large, sigs.join(items, "node"), threshold).distinct(), "tried"))
        if not more.isEmpty():
            links = links.select("a", "b").unionByName(more)
            roots = settle(components(links), "roots")

    nodes = settle(texts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "nodes")
    groups = nodes.groupBy("root").agg(F.min(F.struct("rep", "node")).alias("best"), F.sum("n").alias("class_size"))
    groups = settle(groups, "groups")
    # null ids do not tell classes apart: the kept text does
    own = F.col("best.node").bitwiseOR(F.lit(LEAST))
    first = groups.filter(F.col("best.rep") == LEAST).agg(F.min(own)).first()[0]
    class_id = F.when(F.col("best.rep") > LEAST, F.col("best.rep")).when(own == F.lit(first).cast("bigint"), F.lit(LEAST)).otherwise(own)
    groups = settle(groups.select("root", class_id.alias("class_id"), "class_size", F.col("best.rep").alias("keep_id"), F.col("best.node").alias("keep_node")), "groups")
    table = settle(nodes.join(groups, "root").select("node", "n", "class_id", "class_size", "keep_id", "keep_node"), "classes")
    out = lookup(sketch.select("doc_id", "node"), table, ["node"], "n", "doc_id")
    kept = (F.col("doc_id") == F.col("keep_id")) & (F.col("node") == F.col("keep_node"))
    return out.select("doc_id", "class_id", "class_size", kept.alias("kept"), "node")


def survivors(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay: of each class the one with the smallest id, with all columns.

    Rows that share an id, or have none, are told apart by their texts; of repeated rows one stays.
    """
    found = settle(_placed(docs, threshold), "classes")
    rows = docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LEAST)))
    repeated = settle(found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select(F.col("doc_id").alias("_id")), "repeated")
    lost = settle(found.filter("not kept").select(F.col("doc_id").alias("_id")).distinct(), "lost")
    if repeated.isEmpty():
        return keep_rows(rows, lost, "left_anti", ["_id"]).drop("_id")
    once = keep_rows(keep_rows(rows, repeated, "left_anti", ["_id"]), lost, "left_anti", ["_id"])
    stay = settle(found.filter("kept").select(F.col("doc_id").alias("_id"), F.col("node").alias("_node")).distinct(), "stay")
    odd = keep_rows(rows, repeated, "left_semi", ["_id"]).withColumn("_node", F.arrow_udf(_nodes, "bigint")(text_of()))
    odd = keep_rows(odd, stay, "left_semi", ["_id", "_node"])
    odd = odd.groupBy("_id", "_node").agg(F.max_by(F.struct(*docs.columns), F.struct(F.length(text_of()), text_of())).alias("_row"))
    return once.drop("_id").unionByName(odd.select("_row.*"))
