"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from lanemart.queries import ORACLES, QUERIES
from oracle import connect, difference


@pytest.fixture(scope="module")
def duck(root):
    return connect(root)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, root, duck, name):
    assert difference(QUERIES[name](spark, root), duck, ORACLES[name]) is None


def test_entry_has_rows(spark, root):
    assert len(entry.entry(spark).columns) == 98
