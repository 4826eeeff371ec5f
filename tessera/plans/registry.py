"""The engine's registered queries and their DuckDB equivalents.

A query is a function of (spark, sf_dir) marked with ``@query``; its SQL may
use the fixtures' tables, which are put in front of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.fixtures import with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, **ctes: str):
    """Registers a query under its name, with SQL if there is any."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = with_ctes(sql, **ctes)
        return f

    return add
