"""Exact deduplication by a stream with keyed state on disk."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.base import checked_broadcast, keep_rows, text_of
from tabwright.operators.joins import lookup
from tabwright.session import scratch, settle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RANK = "struct<n_points:bigint,not_id:bigint,not_row:bigint>"
LOG = "digest binary, doc_id bigint, n_points bigint, row bigint"
CONTENT = f"{LOG}, norm string"


def squeezed(text: Column) -> Column:
    """The text without blanks, tabs and line breaks (20, 09-0D)."""
    for c in (" ", "\n", "\t", "\r", "\x0b", "\x0c"):
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def sha256_of(norm: Column) -> Column:
    return F.unhex(F.sha2(norm, 256))


def write_log(docs: DataFrame, path: str, digest: Callable[[Column], Column] = sha256_of, first_row: int = 0, content: str | None = None) -> None:
    """Append one record per row: digest, identifier, length and where the content is (row number of this log).

    The log is what the stream reads. A row number is unique and, once written, fixed. With ``content`` the
    rows' normalised texts go to that folder first, with the same fields, so that later calls can fetch them.
    """
    norm = squeezed(text_of())
    rows = docs.select(
        digest(norm).alias("digest"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.length(text_of()).cast("bigint").alias("n_points"),
        (F.monotonically_increasing_id() + first_row).alias("row"),
        norm.alias("norm"),
    )
    if content:
        rows.write.mode("append").option("compression", "zstd").parquet(content)
        rows = docs.sparkSession.read.schema(CONTENT).parquet(content).filter(F.col("row") >= first_row)
    rows.drop("norm").write.mode("append").parquet(path)


def update_state(spark, log: str, state: str, files_per_batch: int = 512) -> DataFrame:
    """Feed new log files to the keyed state and return the state: digest, best, n.

    The state lives in RocksDB, is snapshot to ``state`` after each batch and never
    expires, so a later call with the same folders goes on where this one ended.
    Per digest it holds the row that stays (longest text, then smallest id, then
    first row) with its place in the log, and the number of rows seen.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # the stores are closed after each batch: an open one holds several MB of disk, however few its keys
    session.conf.set("spark.sql.streaming.stateStore.unloadOnCommit", "true")
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    rank = F.struct("n_points", F.bitwise_not("doc_id").alias("not_id"), F.bitwise_not("row").alias("not_row"))
    kept = (
        session.readStream.schema(LOG)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(log)
        .groupBy("digest")
        .agg(F.max(rank.cast(RANK)).alias("best"), F.count(F.lit(1)).alias("n"))
    )
    query = (
        kept.writeStream.outputMode("update")
        .format("noop")
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    found = spark.read.format("statestore").load(state)
    value = found.schema["value"].dataType.names
    return found.select(
        F.col("key.digest").alias("digest"), F.col(f"value.{value[0]}").cast(RANK).alias("best"), F.col(f"value.{value[1]}").alias("n")
    )


def dedup(
    docs: DataFrame, digest: Callable[[Column], Column] = sha256_of, folder: str | None = None, resume: bool = False
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, digest.

    Texts are equal when they are identical without blanks, tabs and line breaks.
    Rows whose digest occurs more than once are hits: their full bytes are grouped,
    copies collapsing before the shuffle. Texts that share a digest but not their
    bytes form groups of their own.

    Null texts count as empty, and all empty texts are one group. Repeated rows are
    copies of each other: one of them stays. A null id loses against any other at equal
    length. Other columns are ignored. An empty table gives no rows.

    A ``folder`` that is named also holds the normalised texts by row of the log. With ``resume`` it is that of earlier
    calls; the rows of all calls are returned, and the bytes of all of them are compared.
    """
    spark = docs.sparkSession
    content = f"{folder}/content" if folder else None
    folder = folder or scratch(spark, "exact")
    log = spark.read.schema(LOG).parquet
    first = log(f"{folder}/log").agg(F.max("row")).first()[0] if resume else None
    write_log(docs, f"{folder}/log", digest, 0 if first is None else first + 1, content)
    log = log(f"{folder}/log")
    groups = settle(update_state(spark, f"{folder}/log", f"{folder}/state"), "groups")
    out = lookup(log, groups, ["digest"], "n", "row").select(
        "doc_id",
        F.bitwise_not(F.col("best.not_id")).alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.bitwise_not(F.col("best.not_row")) == F.col("row")).alias("kept"),
        "digest",
    )
    norm = squeezed(text_of())
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), digest(norm).alias("digest"), norm.alias("norm"), F.length(text_of()).cast("bigint").alias("n_points"))
    if content:
        rows = spark.read.schema(CONTENT).parquet(content).select(*rows.columns)
    clash = _clashes(rows, groups)
    if clash.isEmpty():
        return out
    rows = keep_rows(rows, clash, "left_semi", ["digest"])
    exact = settle(
        rows.groupBy("digest", "norm").agg(
            F.max(F.struct("n_points", F.bitwise_not("doc_id").alias("not_id"))).alias("best"), F.count(F.lit(1)).alias("n")
        )
    )
    keep = F.bitwise_not(F.col("best.not_id"))
    split = rows.join(exact, ["digest", "norm"]).select(
        "doc_id", keep.alias("keep_id"), F.col("n").alias("group_size"), F.coalesce(F.col("doc_id") == keep, F.lit(True)).alias("kept"), "digest"
    )
    return keep_rows(out, clash, "left_anti", ["digest"]).union(split)


def _clashes(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Digests that stand for several byte sequences, found by comparing the bytes of all hits among ``rows`` (digest, norm)."""
    hits = groups.filter("n > 1").select("digest")
    rows = keep_rows(rows.select("digest", "norm"), hits, "left_semi", ["digest"])
    # a group per digest and full bytes; map tasks send each of them once
    bytes_of = rows.groupBy("digest", "norm").agg(F.count(F.lit(1)).alias("n"))
    return settle(bytes_of.groupBy("digest").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("digest"))


def survivors(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all columns. Of rows that share id and text, the longest one stays."""
    found = settle(dedup(docs), "survivors")
    repeated = settle(found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("doc_id"))
    lost = settle(found.filter(~F.col("kept")).select("doc_id").distinct())
    if repeated.isEmpty():
        return keep_rows(docs, lost, "left_anti")
    once = keep_rows(keep_rows(docs, repeated, "left_anti"), lost, "left_anti")
    odd = keep_rows(docs, repeated, "left_semi")
    best = (
        odd.groupBy(F.col("doc_id").alias("_id"), sha256_of(squeezed(text_of())).alias("_digest"))
        .agg(F.max_by(F.struct(*odd.columns), F.length(text_of())).alias("_row"))
    )
    stay = checked_broadcast(settle(found.filter("kept").select("doc_id", "digest").distinct()))
    same = best["_id"].eqNullSafe(stay["doc_id"]) & (best["_digest"] == stay["digest"])
    return once.unionByName(best.join(stay, same, "left_semi").select("_row.*"))
