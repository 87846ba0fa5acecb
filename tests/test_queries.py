"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as book
from workbook.compare import differences, duck
from workbook import CHAPTERS

NAMES = {query.__name__ for chapter in CHAPTERS for query in chapter.QUERIES}
QUERIES = {name: query for name, query in book.queries().items() if name in NAMES}
SQL = {name: text for name, text in book.oracle_sql().items() if name in NAMES}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert len(QUERIES) == 88


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con.sql(SQL[name])) == []


def test_entry(spark):
    report = book.entry(spark)
    assert report.columns == ["split", "row", "precision", "recall", "f1", "support"]
    assert report.count() == 24
