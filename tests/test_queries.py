"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from checking import assert_same, connect
from pingzones.catalog.oracles import ORACLES
from pingzones.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry_points.queries().keys()
    assert ORACLES.keys() <= entry_points.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf, con, name):
    df = entry_points.queries()[name](spark, sf)
    assert assert_same(df, con, entry_points.oracle_sql()[name]) > 0


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() == 1000
