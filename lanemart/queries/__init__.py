"""Registered queries. Each pairs a Spark query over the driver tables with its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, ctes: bool = True, name: str | None = None):
    """Register a query; ``sql`` is its oracle, run after the shared stand-in definitions."""
    from lanemart.queries.ctes import with_ctes

    def register(fn):
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = with_ctes(sql) if ctes else sql.strip()
        return fn

    return register
