"""Every registered query against its SQL on the smallest scale factor."""

from __future__ import annotations

import pytest
from compare import connect, difference

import __spark_entry__ as contract
from papertrove.plans import catalog

SMALL = "/root/testdata/sf0.001"
# Approximate by design; its recall is tested in test_search.py.
ROWS_ONLY = {"knn_approx"}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) - set(catalog.ORACLES) == ROWS_ONLY
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["doc_id", "chunk_index", "content", "score"]
    assert rows.count() == 5


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, duck, name):
    sql = contract.oracle_sql()[name].replace("/root/testdata/sf0.01", SMALL)
    assert difference(contract.queries()[name](spark, SMALL), duck, sql) is None
