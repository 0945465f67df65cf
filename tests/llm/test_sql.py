"""Registered queries against their SQL, and every one of them over a supplied table."""

import pytest

from rxstrata.checks import compare
from rxstrata.llm.oracle import ORACLES
from rxstrata.llm.queries import QUERIES, table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return compare.oracle_connection(FOLDER)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, documents, connection, monkeypatch, name):
    documents()
    monkeypatch.setattr(compare, "ORACLES", ORACLES)
    assert compare.differences(QUERIES[name](spark, FOLDER), connection, name) == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_query_answers_for_every_row(spark, documents, name):
    documents()
    rows = QUERIES[name](spark, FOLDER)
    assert rows.count() == table(spark, FOLDER, "documents").count()
    assert rows.select("doc_id").distinct().count() == rows.count()
