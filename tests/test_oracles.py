"""Every registered query against its SQL, on the smallest tables; the others must give rows."""

from __future__ import annotations

import pytest
from conftest import SMALL
from oracle import compare

import __spark_entry__ as contract

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    assert compare(spark, name, QUERIES[name], ORACLES[name], SMALL) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert not QUERIES[name](spark, SMALL).isEmpty()


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() == 4
    assert df.columns[0] == "hour_of_day"
