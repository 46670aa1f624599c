"""Registered queries beside their SQL counterparts, and the pipeline."""

import duckdb
import pytest

import corpus_pipeline
import oracle_check
from daypanel.llm import queries
from daypanel.llm.base import table


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_sql(spark, sf, name):
    con = duckdb.connect()
    for t in oracle_check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    assert oracle_check.compare(spark, con, name, sf).startswith("ok")


def test_all_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark, sf):
    docs = table(spark, sf, "documents")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        assert set(docs.columns) <= set(out.columns), name
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        assert out.select("doc_id").exceptAll(docs.select("doc_id")).isEmpty()
        docs = out.cache()
    assert not docs.isEmpty()


def test_stages_on_edge_rows(spark, documents, empty, sf):
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, documents, sf).collect()
        assert stage(spark, empty, sf).isEmpty()


def test_one_document_of_each_group(spark, documents, sf):
    got = corpus_pipeline.one_of_each_group(spark, documents, sf)
    ids = sorted((r.doc_id for r in got.collect()), key=lambda x: (x is None, x))
    # 2 and 3 go with 1, 8 with 7, one of the repeated rows 10; a null id and texts without words stay
    assert ids == [1, 4, 5, 6, 7, 9, 10, 11, 12, None]


def test_leaks_take_no_other_text_of_their_id(spark, sf):
    item = table(spark, sf, "benchmark").where("size(split(text, ' ')) >= 20").orderBy("item_id").first().text
    rows = [(None, item), (None, "a clean text without an id"), (7, item), (7, "another clean text"), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in corpus_pipeline.drop_leaks(spark, docs, sf).collect()}
    assert got == {rows[1], rows[3], rows[4]}
