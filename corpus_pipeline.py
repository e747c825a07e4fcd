"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps, which are written as Parquet
and read again as the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm import exact_dedup, near_dedup, pieces, toxicity
from tabwright.llm.base import documents, text_of
from tabwright.llm.queries import mixed
from tabwright.session import settle


#: Rows of an Arrow batch in this application: a batch holds whole texts or multisets of words.
BATCH_ROWS = 1000


def _narrow(spark: SparkSession) -> None:
    """Set the session's Arrow batches to BATCH_ROWS at most: each task holds several of them outside the heap."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def _apart(docs: DataFrame, taken: tuple[str, ...], stage) -> DataFrame:
    """``stage(docs)`` with columns whose names the stage's operator takes for its own put aside meanwhile."""
    clash = [c for c in docs.columns if c.lower() in taken]
    aside = docs.withColumnsRenamed({c: f"_aside_{i}" for i, c in enumerate(clash)})
    back = stage(aside).drop(*taken).withColumnsRenamed({f"_aside_{i}": c for i, c in enumerate(clash)})
    return back.select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among them, does not reject."""
    _narrow(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(toxicity.verdict(text_of(), model) < 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for blanks and line breaks, the longest, then the smallest id."""
    _narrow(spark)
    return exact_dedup.survivors(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    _narrow(spark)
    return near_dedup.survivors(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens have the production shares of sources, languages and topics."""
    _narrow(spark)
    return _apart(docs, ("topic", "n_tokens", "weight", "probability", "kept"), lambda d: mixed(d).filter("kept"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document that is left."""
    _narrow(spark)
    found = pieces.encode(docs, dropout=0.1, seed=1, check=True)
    return found.select("doc_id", "lang", "source", F.size("ids").alias("n_ids"), "ids", "lossless")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("pieces", encode_pieces),
]

#: Learned scores, signatures and keyed draws have no SQL form; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
