"""The pipeline's stages and the registered queries."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clickweave.llm import common, near_copies, queries

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = common.written(stage(spark, docs, SF), name)
        assert after.columns == documents.columns
        if name == "near_copies":
            classes = near_copies.deduplicate(docs)
            assert after.count() == classes.select("class_id").distinct().count()
        elif name == "secret_scan":
            assert after.count() == docs.count()
        assert after.filter("text RLIKE 'AKIA[A-Z0-9]{14}'").isEmpty() or name != "secret_scan"
        docs = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in docs.collect()}
    assert docs.count() > 0.7 * documents.count()


def test_run_gives_the_same_rows_again(spark):
    one, two = (sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) for _ in range(2))
    assert one == two and one


def run_over(spark, folder, documents, labels=()):
    documents.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return corpus_pipeline.run(spark, str(folder)).collect()


def test_empty_tables(spark, tmp_path, empty):
    assert run_over(spark, tmp_path, empty) == []


def test_awkward_rows(spark, tmp_path, awkward):
    """Texts without letters are rejected, of the equal ones one stays, and extra columns do no harm."""
    pieces = run_over(spark, tmp_path, awkward, [(4, 1, 0), (6, 0, 1), (None, 1, 1), (9, None, None)])
    assert {2, 3, 8}.isdisjoint(r.doc_id for r in pieces)
    assert len({r.doc_id for r in pieces} & {6, 7}) <= 1
    for doc in {r.doc_id for r in pieces}:
        own = sorted((r.start, r.length, r.doc_tokens) for r in pieces if r.doc_id == doc)
        assert sum(length for _, length, _ in own) == own[0][2]


def test_tables_without_languages_are_kept(spark, tmp_path, documents):
    some = documents.filter("doc_id % 8 = 1 AND text IS NOT NULL").withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.identify_language(spark, some, "").count() == some.count()
    assert len({r.doc_id for r in run_over(spark, tmp_path, some)}) > 10


@pytest.mark.parametrize("name", queries.QUERIES)
def test_queries_equal_their_sql(spark, name):
    frame = queries.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in frame.collect()]
    assert rows or name.startswith("op2")
    if name in queries.ORACLE:
        connection = duckdb.connect()
        for table in ("documents", "embeddings", "pages", "benchmark"):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
        expected = connection.execute(queries.ORACLE[name])
        columns = [x[0] for x in expected.description]
        order = [frame.columns.index(c) for c in columns]
        key = lambda row: tuple(map(repr, row))
        got = sorted((tuple(row[i] for i in order) for row in rows), key=key)
        for a, b in zip(got, sorted(expected.fetchall(), key=key), strict=True):
            assert a == pytest.approx(b)
