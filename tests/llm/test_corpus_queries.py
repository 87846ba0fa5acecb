"""Registered queries on the smallest tables."""

import pytest

import __spark_entry__ as book
from gradloom.llm import queries as corpus
from workbook.compare import differences, duck


def test_all_operators_are_registered():
    names = {q.__name__ for q in corpus.QUERIES}
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in names}
    assert names | {"pipeline"} <= set(book.queries())
    assert set(corpus.SQL) <= names


@pytest.mark.parametrize("name", sorted(corpus.SQL))
def test_query_equals_sql(spark, sf_dir, name):
    assert differences(book.queries()[name](spark, sf_dir), duck(sf_dir).sql(corpus.SQL[name])) == []


@pytest.mark.parametrize("name", sorted(q.__name__ for q in corpus.QUERIES if q.__name__ not in corpus.SQL))
def test_query_covers_its_table(spark, sf_dir, name):
    rows = book.queries()[name](spark, sf_dir)
    assert rows.columns == list(dict.fromkeys(rows.columns))
    found = rows.collect()
    if "doc_id" in rows.columns and name != "op5_patience_licenses":
        docs = {r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").collect()}
        assert {r["doc_id"] for r in found} == docs
    assert found
