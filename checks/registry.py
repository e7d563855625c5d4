"""Collects the registered queries of all check modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, oracle: str | None = None):
    """Register a query, with the SQL of its expected result where there is one."""

    def add(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = query
        if oracle is not None:
            ORACLES[name] = oracle
        return query

    return add
