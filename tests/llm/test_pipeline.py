import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not found")


def test_stages(spark):
    import corpus_pipeline
    from tabwright.llm import exact_dedup, mixing, near_dedup, queries, toxicity
    from tabwright.llm.base import documents
    from tabwright.session import settle

    docs = documents(spark, SF)
    columns = docs.columns
    kept = {}
    frames = {}
    for name, stage in corpus_pipeline.STAGES:
        frames[name] = docs
        docs = settle(stage(spark, docs, SF))
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name != "pieces":
            assert docs.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "pieces"]
    # every stage against its operator's own decisions
    model = toxicity.train(frames["toxicity"], spark.read.parquet(f"{SF}/labels.parquet"))
    assert kept["toxicity"] == {r.doc_id for r in toxicity.score(frames["toxicity"], model).filter("predicted = 0").collect()}
    assert kept["exact_dedup"] == {r.doc_id for r in exact_dedup.dedup(frames["exact_dedup"]).filter("kept").collect()}
    assert kept["near_dedup"] == {r.doc_id for r in near_dedup.classes(frames["near_dedup"]).filter("doc_id = class_id").collect()}
    assert kept["mixing"] == {r.doc_id for r in queries.mixed(frames["mixing"]).filter("kept").collect()}
    assert kept["pieces"] == kept["mixing"] and docs.filter("NOT lossless").count() == 0
    assert mixing.MAX_VALUES > 0


def test_stages_keep_clashing_columns(spark, odd_rows):
    import corpus_pipeline

    extra = ", score string, kept int, topic string, node int, digest string, ids string, n_tokens string"
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint" + extra
    rows = [(*r, "s", 1, "t", 2, "d", "i", "n") for r in odd_rows]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == [c.split()[0] for c in schema.split(", ")]
            assert {r.score for r in docs.collect()} <= {"s"}, name


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()}
    assert "pipeline" in names


@pytest.mark.parametrize("name", ["op4_tiled_topk", "op6_streaming_exact_dedup", "op13_branch_and_bound_repair"])
def test_sql_twins(spark, name):
    import duckdb

    import __spark_entry__ as entry

    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = entry.queries()[name](spark, SF)
    r = con.execute(entry.oracle_sql()[name])
    order = [[d[0] for d in r.description].index(c) for c in df.columns]
    assert sorted(map(tuple, df.collect())) == sorted(tuple(x[i] for i in order) for x in r.fetchall())
