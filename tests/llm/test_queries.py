"""The registered queries, their SQL, and the pipeline stage by stage."""

import inspect
import re

import duckdb
import pytest

import corpus_pipeline
from blotter.llm import chunk_dedup, ngram_join, quality_rules, queries
from blotter.llm.shared import table
from tests.oracle_compare import rows_of

SMALL = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    assert [int(re.match(r"op(\d+)_", k)[1]) for k in queries.queries() if k != "pipeline"] == list(range(1, 14))
    assert all(len(inspect.signature(f).parameters) == 2 for f in queries.queries().values())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    found = con.execute(queries.oracle_sql()[name])
    columns, want = [c[0] for c in found.description], found.fetchall()
    got = queries.queries()[name](spark, SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(columns, want)


def test_pipeline_stages_take_effect(spark, tmp_path):
    docs = table(spark, SMALL, "documents")
    labels = table(spark, SMALL, "labels")
    before = {r.doc_id: r for r in docs.collect()}
    kept = None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        if k == 0:
            want = {r.doc_id for r in quality_rules.quality_verdicts(docs, labels).where("kept").collect()}
        elif k == 1:
            want = {r.doc_id for r in chunk_dedup.exact_groups(docs).where("kept").collect()}
        elif k == 2:
            want = {r.doc_id for r in ngram_join.jaccard_components(docs, shingle=5, num=80).where("doc_id = component_id").collect()}
        else:
            want = kept
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept = {r.doc_id for r in docs.select("doc_id").collect()}
        assert kept == want and kept
        if k == 3:
            for r in docs.collect():
                assert r.n_chars == len(r.text)
                assert r.text == before[r.doc_id].text or "[SECRET]" in r.text
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(docs.columns)


def test_pipeline_of_an_empty_table(spark):
    docs = table(spark, SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        assert out.collect() == []
        docs = docs.sparkSession.createDataFrame([], docs.schema)
