"""Queries with SQL twins, and edge cases that hold for all operators."""

import os

import pytest
from pyspark.sql import functions as F

from pressmill.llm import (
    catalog,
    chat_format,
    cross_polytope,
    disclosure,
    html_blocks,
    interleave,
    lsh_forest,
    merkle,
    nnls_packing,
    speculative_bpe,
    toxicity,
)
from tests.oracle import connect, difference, spark_rows, sql_rows


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_as_sql(spark, folder, name):
    mine = spark_rows(catalog.QUERIES[name](spark, folder))
    assert difference(mine, sql_rows(connect(folder), catalog.ORACLES[name])) == ""


def test_all_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES) == list(range(1, 14))


def _tables(spark, docs, path):
    docs.write.parquet(f"{path}/documents.parquet")
    labels = [(1, 1, 1), (1, 1, 0), (None, 1, 1), (2, None, None), (5, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet"
    )
    return str(path)


DOCUMENT_QUERIES = [n for n in catalog.QUERIES if int(n[2:].split("_")[0]) in (4, 5, 6, 7, 8, 10, 11, 12, 13)]


@pytest.fixture(scope="session")
def odd_folder(spark, odd_docs, tmp_path_factory):
    return _tables(spark, odd_docs, tmp_path_factory.mktemp("odd"))


@pytest.fixture(scope="session")
def empty_folder(spark, odd_docs, tmp_path_factory):
    return _tables(spark, odd_docs.where("false"), tmp_path_factory.mktemp("empty"))


@pytest.mark.parametrize("name", DOCUMENT_QUERIES)
def test_odd_rows_are_all_answered(spark, odd_folder, odd_docs, name):
    found = catalog.QUERIES[name](spark, odd_folder).select("doc_id").collect()
    wanted = odd_docs.select("doc_id").collect()
    assert sorted(map(str, found)) == sorted(map(str, wanted))


@pytest.mark.parametrize("name", DOCUMENT_QUERIES)
def test_empty_table(spark, empty_folder, name):
    assert catalog.QUERIES[name](spark, empty_folder).count() == 0


def test_odd_rows_of_the_other_tables(spark):
    pages = spark.createDataFrame(
        [(None, None, None), (1, "u", ""), (1, "u", ""), (2, "u", "<p"), (3, "u", "<p>a<b>c</p>" * 9000)],
        "page_id long, url string, html string, text string".replace(", text string", ""),
    ).withColumn("text", F.lit("clash"))
    got = {(r.page_id, len(r.text)) for r in html_blocks.extract(pages).collect()}
    assert got == {(None, 0), (1, 0), (2, 0), (3, 3 * 9000 - 1)}
    assert html_blocks.extract(pages).count() == 5
    assert html_blocks.extract(pages.where("false")).count() == 0
    kinds = "conv_id long, turn long, role string, text string, formatted string"
    rows = spark.createDataFrame(
        [(None, None, None, None, "x"), (None, None, None, None, "x"), (1, 1, "a\nb\\n", "<|", "x")], kinds
    )
    done = chat_format.format_conversations(rows)
    turns = {
        r.conv_id: [tuple(t) for t in r.turns]
        for r in done.select("conv_id", chat_format.read_turns(F.col("formatted")).alias("turns")).collect()
    }
    assert turns == {None: [("", ""), ("", "")], 1: [("a\nb\\n", "<|")]}
    assert chat_format.format_conversations(rows.where("false")).count() == 0
    vectors = spark.createDataFrame(
        [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, []),
         (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]),
         (8, [1e200, 1e200]), (9, [1.0, 0.0])],
        "id long, vector array<double>",
    )
    found = cross_polytope.nearest(vectors, vectors.where("id % 50 = 0"))
    got = [tuple(r) for r in found.orderBy("rank").collect()]
    assert [(q, r, v) for q, r, v, _ in got] == [(0, 1, 1), (0, 2, 9), (0, 3, 8)]
    assert [s for *_, s in got] == pytest.approx([1.0, 1.0, 2**-0.5], abs=1e-15)
    assert cross_polytope.nearest(vectors.where("false"), vectors.where("false")).count() == 0


def test_packing_of_odd_rows(spark, odd_docs):
    pieces = nnls_packing.pack_documents(odd_docs).collect()
    assert sum(r.length for r in pieces if r.start == 0 and r.doc_id in (2, 3, 4)) == 3
    assert all(r.offset + r.length <= 2048 for r in pieces)
    assert nnls_packing.pack_documents(odd_docs.where("false")).count() == 0


def test_stages_keep_the_columns(spark, odd_docs, odd_folder):
    import corpus_pipeline

    docs = odd_docs
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, odd_folder)
        assert out.columns == odd_docs.columns
        assert out.count() <= docs.count()
    kept = lsh_forest.keep_one(spark, odd_docs, odd_folder)
    assert {r.doc_id for r in kept.collect()} == {None, 1, 2, 5, 6, 7, 8, 9, 10}


def test_the_package_has_no_swallowed_imports():
    for module in (interleave, merkle, speculative_bpe, toxicity, disclosure):
        with open(module.__file__, encoding="utf-8") as f:
            assert "ImportError" not in f.read()
    assert os.path.exists("corpus_pipeline.py")
