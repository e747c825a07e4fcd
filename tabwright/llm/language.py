"""Language identification by Bayesian fusion of text, declared markup, address suffix and host priors."""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.base import lowered, mix, per_slice, row_index, slices, strings, text_of
from tabwright.operators.joins import lookup
from tabwright.session import settle

#: Buckets that the byte trigrams of a language are counted in; with LANGUAGES this bounds the model.
BUCKETS = 1 << 15
#: Languages told apart at most: those with the most training text.
LANGUAGES = 200
#: Added to every count of trigrams; of declared languages, suffixes.
ALPHA, EVIDENCE_ALPHA = 0.5, 0.5
#: Neighbouring trigrams say much the same: their log-likelihoods count by this.
TEXT_WEIGHT = 0.3
#: Pages that a level of the host hierarchy counts for in the level below it.
STRENGTH = 10.0

_DROP = re.compile(r"<!--.*?-->|<(script|style|noscript|template)\b.*?</\1\s*>|<[^>]*>", re.S | re.I)
_DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,8})", re.I)
_META = re.compile(r"<meta\b[^>]*content-language[^>]*content\s*=\s*[\"']?([A-Za-z]{2,8})", re.I)


def visible(page: str) -> str:
    """The text of a page without markup, scripts and comments, entities resolved."""
    return entities.unescape(_DROP.sub(" ", page))


def declared(page: str) -> str | None:
    """The primary language that the markup declares, in lower case."""
    m = _DECLARED.search(page) or _META.search(page)
    return m[1].lower() if m else None


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams inside each row (A-Z lower-cased, runs of digits and signs left out), and their rows."""
    low = lowered(data).astype(np.uint32)
    if len(low) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = (low >= 128) | ((low >= 97) & (low <= 122))
    low = np.where(word, low, 32).astype(np.uint32)
    key = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
    rows = row_index(np.diff(offsets))
    good = (rows[2:] == rows[:-2]) & word[1:-1]
    bucket = (mix(key[good].astype(np.uint64)) % np.uint64(BUCKETS)).astype(np.int64)
    return bucket, rows[2:][good]


def text_model(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and the log probability of each trigram bucket in each of them.

    All rows with a language count; tasks add up before the shuffle, so BUCKETS rows per language arrive.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            data, offsets = strings(batch.column("text"))
            langs = np.array(batch.column("lang").to_pylist(), object)
            for i, j in slices(offsets):
                bucket, row = trigrams(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                names, code = np.unique(langs[i:j].astype(str), return_inverse=True)
                got = np.bincount(code[row] * BUCKETS + bucket, minlength=len(names) * BUCKETS).reshape(len(names), BUCKETS)
                for n, c in zip(names, got, strict=True):
                    sums[n] = sums[n] + c if n in sums else c
        for name, c in sums.items():
            at = np.flatnonzero(c)
            cols = [pa.array([name] * len(at)), pa.array(at.astype(np.int32)), pa.array(c[at].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, names=["lang", "bucket", "n"])

    known = docs.filter(F.col("lang").isNotNull()).select(F.col("lang").cast("string").alias("lang"), text_of().alias("text"))
    counts = known.mapInArrow(run, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = settle(counts, "trigrams")
    size = counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    names = sorted(r["lang"] for r in size)
    table = np.full((len(names), BUCKETS), ALPHA)
    if names:
        got = counts.filter(F.col("lang").isin(names)).toArrow()
        place = {n: i for i, n in enumerate(names)}
        rows = np.array([place[n] for n in got.column("lang").to_pylist()], np.int64)
        table[rows, got.column("bucket").to_numpy()] += got.column("n").to_numpy()
    return names, np.log(table / table.sum(axis=1, keepdims=True))


def _vector(names: list[str], of) -> Column:
    return F.array(*[of(i) for i in range(len(names))])


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    e = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """One row per page: page_id, lang, probability, text_lang, declared, suffix, host, n_trigrams, posterior.

    The log posterior of a language adds up: the log-likelihood of the visible text under the trigram counts of
    ``docs`` (text, lang), times TEXT_WEIGHT; log P(declared language | language) and log P(suffix | language); and the
    log prior of the page's host. The last three are learned from the pages themselves by
    grouped aggregation of their text posteriors: a host's prior is its own counts smoothed towards
    its domain's (the last two labels), the domain's towards those of all pages. A page's own
    posterior is left out of its host's and domain's counts.

    Null text and addresses count as empty: without text only the other evidence speaks, without an
    address host, domain and suffix are ''. Ties go to the alphabetically first language. Repeated rows are
    separate pages. Without training text ``lang`` is null. Other columns are ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    names, logp = text_model(docs)
    out_cols = "page_id bigint, lang string, probability double, text_lang string, declared string, suffix string, host string, n_trigrams bigint, posterior array<double>"
    source = pages.select(F.col("page_id").cast("bigint").alias("page_id"), text_of("url").alias("url"), text_of("html").alias("text"))
    model = spark.sparkContext.broadcast(logp)

    def run(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        raw = batch.column("text").to_pylist()
        shown, at = strings(pa.array([visible(t) for t in raw], pa.large_string()))
        bucket, row = trigrams(shown, at)
        n = np.bincount(row, minlength=len(raw)).astype(np.int64)
        ll = [np.bincount(row, logs[bucket], len(raw)).astype(np.float64) for logs in model.value]
        flat = np.stack(ll, axis=1).ravel() if ll else np.zeros(0)
        lists = pa.ListArray.from_arrays(np.arange(len(raw) + 1, dtype=np.int32) * len(ll), pa.array(flat))
        cols = [batch.column("page_id"), batch.column("url"), pa.array([declared(t) for t in raw], pa.string()), pa.array(n), lists]
        return pa.RecordBatch.from_arrays(cols, names=["page_id", "url", "declared", "n_trigrams", "ll"])

    read = source.mapInArrow(per_slice(run), "page_id bigint, url string, declared string, n_trigrams bigint, ll array<double>")
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    if not names:
        bare = read.select("page_id", "declared", "n_trigrams", host.alias("host"), F.regexp_extract(host, r"([^.]*)$", 1).alias("suffix"))
        return bare.selectExpr("page_id", "string(null) lang", "double(null) probability", "string(null) text_lang", "declared", "suffix", "host", "n_trigrams", "array() posterior").select(*[F.col(c.split()[0]).cast(c.split(" ", 1)[1]) for c in out_cols.split(", ")])
    read = read.withColumn("host", host)
    read = read.withColumn("domain", F.regexp_extract("host", r"([^.]*\.)?[^.]*$", 0)).withColumn("suffix", F.regexp_extract("host", r"[^.]*$", 0))
    weighed = F.transform("ll", lambda x: x * TEXT_WEIGHT)
    read = settle(read.drop("url").withColumn("q", _softmax(weighed)), "evidence")
    # a declared language that no text is in says that something else is meant
    said = F.when(F.col("declared").isin(names), F.col("declared")).when(F.col("declared").isNull(), "").otherwise("(other)")
    read = read.withColumn("said", said)
    sums = [F.sum(F.col("q")[i]).alias(f"s{i}") for i in range(len(names))]
    both = _vector(names, lambda i: F.col(f"s{i}"))

    by_host = read.groupBy("host", "domain", "suffix").agg(*sums, F.count(F.lit(1)).alias("n"))
    by_host = settle(by_host.select("host", "domain", "suffix", both.alias("of_host"), "n"), "hosts")
    add_up = [F.sum(F.col("of_host")[i]).alias(f"s{i}") for i in range(len(names))]
    by_domain = settle(by_host.groupBy("domain").agg(*add_up, F.sum("n").alias("n_domain")).select("domain", both.alias("of_domain"), "n_domain"), "domains")
    by_suffix = settle(by_host.groupBy("suffix").agg(*add_up).select("suffix", both.alias("of_suffix")), "suffixes")
    overall = by_suffix.agg(*[F.sum(F.col("of_suffix")[i]).alias(f"s{i}") for i in range(len(names))], F.count(F.lit(1)).alias("k")).first()
    whole = [float(overall[f"s{i}"] or 0.0) for i in range(len(names))]
    kinds = int(overall["k"])
    said_by = {r["said"]: [float(r[f"s{i}"]) for i in range(len(names))] for r in read.groupBy("said").agg(*sums).collect()}
    total = sum(whole) or 1.0
    share = [(x + ALPHA) / (total + ALPHA * len(names)) for x in whole]

    hosts = by_host.join(by_domain, "domain").join(by_suffix, "suffix").select("host", "n", "of_host", "of_domain", "n_domain", "of_suffix")
    rows = lookup(read, settle(hosts, "hosts"), ["host"], "n", "page_id")
    stated = F.create_map(*[x for k, v in sorted(said_by.items()) for x in (F.lit(k), F.array(*[F.lit(math.log((s + EVIDENCE_ALPHA) / (w + EVIDENCE_ALPHA * (len(names) + 2)))) for s, w in zip(v, whole, strict=True)]))]) if said_by else None

    def prior(i: int) -> Column:
        rest = F.greatest(F.col("of_domain")[i] - F.col("q")[i], F.lit(0.0))
        domain = (rest + STRENGTH * share[i]) / (F.col("n_domain") - 1 + STRENGTH)
        own = F.greatest(F.col("of_host")[i] - F.col("q")[i], F.lit(0.0))
        return (own + STRENGTH * domain) / (F.col("n") - 1 + STRENGTH)

    def evidence(i: int) -> Column:
        suffix = F.log((F.col("of_suffix")[i] + EVIDENCE_ALPHA) / (whole[i] + EVIDENCE_ALPHA * (kinds + 1)))
        return F.col("ll")[i] * TEXT_WEIGHT + F.col("_said")[i] + suffix + F.log(prior(i))

    if stated is None:  # no pages
        return spark.createDataFrame([], out_cols)
    rows = rows.withColumn("_said", stated[F.col("said")])
    rows = rows.withColumn("posterior", _softmax(_vector(names, evidence)))
    langs = F.array(*map(F.lit, names))
    best = lambda p: F.when(F.col("n_trigrams") >= 0, langs[F.array_position(p, F.array_max(p)).cast("int") - 1])
    return rows.select(
        "page_id", best(F.col("posterior")).alias("lang"), F.array_max("posterior").alias("probability"),
        F.when(F.col("n_trigrams") > 0, best(F.col("q"))).alias("text_lang"), "declared", "suffix", "host", "n_trigrams", "posterior",
    )
