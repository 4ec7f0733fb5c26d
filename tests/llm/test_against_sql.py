"""Registered queries of the operators next to their SQL."""

from __future__ import annotations

import pytest

from lanemart.llm.queries import ORACLES, QUERIES
from oracle import connect, difference


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, root, name):
    assert difference(QUERIES[name](spark, root), connect(root), ORACLES[name]) is None


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", [n for n in QUERIES if n.split("_")[0] in ("op3", "op7", "op8", "op10")])
def test_native_plans(spark, root, name):
    text = QUERIES[name](spark, root)._jdf.queryExecution().executedPlan().toString()
    assert not [b for b in ("EvalPython", "InArrow", "InPandas", "CartesianProduct", "NestedLoop") if b in text]
