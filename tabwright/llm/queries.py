"""The named queries over the text operators, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm import alignment, conversations, exact_dedup, language, mixing, near_dedup, pieces, ppm, quality, secrets, shards, topk, toxicity
from tabwright.llm.base import crc_fold, documents, text_of

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query(
    "op6_streaming_exact_dedup",
    r"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
    g AS (SELECT norm, count(*) AS group_size FROM t GROUP BY norm),
    k AS (SELECT norm, doc_id AS keep_id FROM (
        SELECT norm, doc_id, row_number() OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) AS rn FROM t) WHERE rn = 1)
    SELECT t.doc_id, k.keep_id, g.group_size, t.doc_id = k.keep_id AS kept, sha256(t.norm) AS text_sha256
    FROM t JOIN g USING (norm) JOIN k USING (norm)""",
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.dedup(documents(spark, sf_dir))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query(
    "op4_tiled_topk",
    """
    WITH v AS (SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q FROM embeddings
        WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
    p AS (SELECT a.vec_id AS query_id, b.vec_id, list_sum([z[1] * z[2] FOR z IN list_zip(a.q, b.q)]) AS score
        FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 10""",
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.search(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


@query("op9_hypergeometric_shards")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = shards.shuffle(documents(spark, sf_dir), 24)
    return dealt.select(
        "doc_id",
        (F.octet_length(text_of()).cast("bigint") + 8).alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


#: Source and topic shares are evened out by these powers of what there is; languages have fixed shares.
MIXTURE = {"source": 0.7, "lang": {"en": 0.55, "de": 0.16, "fr": 0.16, "es": 0.13}, "topic": 0.8}


def mixed(docs: DataFrame) -> DataFrame:
    """The production mixture: half of the tokens, raked to source, language and topic."""
    return mixing.mix(docs.withColumn("topic", mixing.topic_of(text_of())), MIXTURE, share=0.5)


@query("op10_raked_mixture")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(documents(spark, sf_dir)).select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "kept")


@query("op2_merge_dropout_pieces")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(documents(spark, sf_dir).select("doc_id", "text"))


def encoded(docs: DataFrame) -> DataFrame:
    """Ids of every document at the production dropout, and whether they decode to the text."""
    return pieces.encode(docs, dropout=0.1, seed=1, check=True).select("doc_id", F.size("ids").alias("n_ids"), "ids", "lossless")


def _count(kind: str):
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


@query("op3_guess_cost_secrets")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = secrets.scan(docs)
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id",
        *[_count(k) for k in secrets.KINDS],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        F.array_max(F.transform("spans", lambda s: s["cost"])).alias("top_cost"),
    )


@query("op1_compression_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found = toxicity.score(docs, model)
    return found.select("doc_id", (crc_fold(toxicity.FOLDS) == 0).alias("held_out"), "score", "predicted", "n_windows")


@query("op7_ppm_scores")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(documents(spark, sf_dir))


@query("op5_bagminhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(documents(spark, sf_dir))


@query("op8_language_fusion")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(spark.read.parquet(f"{sf_dir}/pages.parquet"), documents(spark, sf_dir))


def _edit(way: str, cost: str, letter: str, row: str = "[]") -> str:
    more = f"{{'c': {way}.c + {cost}, 'a': {way}.a || '{letter}', 'r': {way}.r || {row}}}"
    return f"CASE WHEN {way} IS NOT NULL THEN {more} END"


def _relabelled(way: str, role: str) -> str:
    return _edit(way, "1 + cut", "R", f"['{role}:' || text]")


def _kept(way: str, initial: str) -> str:
    return f"CASE WHEN left(role, 1) = '{initial}' THEN {_edit(way, 'cut', 'K', _AS_IT_IS)} END"


def _least(*ways: str) -> str:
    return "list_min([" + ", ".join(ways) + "])"


def _unless_forced(*ways: str) -> str:
    return f"CASE WHEN fault IN ('', 't') THEN {_least(*ways)} END"


_AS_IT_IS = "[role || ':' || text]"
#: Ways to each state (nothing, system, user, assistant last) before the next row, insertions among them.
_AFTER_USER = _least("w2", *[_edit(f"w{s}", "5", "I", "['user:']") for s in (0, 1, 3)])
_AFTER_BOTH = _least("w3", _edit("v2", "5", "I", "['assistant:']"))
_WAY = "STRUCT(c BIGINT, a VARCHAR, r VARCHAR[])"
_TO_USER = [e for s in ("w0", "w1", "v3") for e in (_kept(s, "u"), _relabelled(s, "user"))]

_OP13_SQL = rf"""
    WITH RECURSIVE poly AS (SELECT list_transform(range(256), lambda b: list_reduce([b] || range(8),
        lambda c, j: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
    raw AS (SELECT conv_id, turn, coalesce('=' || conv_id, '') AS k, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS id FROM conversations),
    hit AS (SELECT raw.*, xor(list_reduce([4294967295] || list_transform(range(1, length(id) + 1), lambda i: CAST(ascii(substr(id, i, 1)) AS BIGINT)),
        lambda c, b: xor(c >> 8, tab[(xor(c, b) % 256) + 1])), 4294967295) % 20 AS how FROM raw, poly),
    hurt AS (SELECT k, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
        CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE how WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hit),
    dig AS (SELECT *, sha256(k || chr(10) || length(role) || chr(10) || role || text) AS d,
        trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM hurt),
    o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, d) AS i FROM dig),
    f AS (SELECT *, row_number() OVER (PARTITION BY k, role, text ORDER BY i) AS again,
        lag(left(role, 1)) OVER (PARTITION BY k ORDER BY i) || left(role, 1) AS pair FROM o),
    g AS (SELECT *, CASE WHEN body = '' THEN 'b' WHEN again > 1 THEN 'd' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM f),
    t AS (SELECT *, CASE WHEN fault = 't' THEN 5 ELSE 0 END AS cut FROM g),
    way(k, i, w0, w1, w2, w3) AS (
        SELECT DISTINCT k, CAST(0 AS BIGINT), CAST({{'c': 0, 'a': '', 'r': []}} AS {_WAY}), CAST(NULL AS {_WAY}), CAST(NULL AS {_WAY}), CAST(NULL AS {_WAY}) FROM raw
        UNION ALL
        SELECT k, i, {_edit("w0", "2", "D")},
            {_least(_edit("w1", "2", "D"), _unless_forced(_kept("w0", "s")))},
            {_least(_edit("v2", "2", "D"), _unless_forced(*_TO_USER))},
            {_least(_edit("v3", "2", "D"), _unless_forced(_kept("v2", "a"), _relabelled("v2", "assistant")))}
        FROM (SELECT *, {_AFTER_BOTH} AS v3 FROM (SELECT way.k, t.i, w0, w1, w2, w3, t.role, t.text, t.fault, t.cut, {_AFTER_USER} AS v2
            FROM way JOIN t ON t.k = way.k AND t.i = way.i + 1))),
    n AS (SELECT k, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
        count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM t GROUP BY k),
    last AS (SELECT k, i, {_least("w0", "v3")} AS w FROM (SELECT *, {_AFTER_BOTH} AS v3 FROM (SELECT *, {_AFTER_USER} AS v2 FROM way)))
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
        coalesce(illegal, 0) AS illegal, w.c AS cost, w.a AS audit, sha256(array_to_string(w.r, chr(10))) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id, k FROM raw) c LEFT JOIN n ON n.k = c.k JOIN last ON last.k = c.k AND last.i = coalesce(n.rows, 0)"""


@query("op13_branch_and_bound_repair", _OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


@query("op12_fourier_ridge_quality")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.select("doc_id", (crc_fold(quality.FOLDS) == 0).alias("held_out"), "score", "predicted")


@query("op11_identity_map_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.scored(alignment.align(documents(spark, sf_dir)))
