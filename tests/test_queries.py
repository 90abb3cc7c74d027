"""Every registered query against DuckDB on the smallest data set."""

import pytest

from tests.conftest import SMALL
from tools.check import compare, connect

import __spark_entry__ as book


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(book.queries()))
def test_query_agrees_with_sql(spark, duck, name):
    good, text = compare(spark, duck, name, SMALL)
    assert good, text


def test_every_sql_text_has_a_query():
    assert set(book.oracle_sql()) <= set(book.queries())


def test_entry_runs(spark):
    frame = book.entry(spark)
    assert "buildingCandidateId" in frame.columns
    assert frame.count() > 0
