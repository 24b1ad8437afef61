"""The registry of named queries with their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .views import check_sql

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, uses: str = "", sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``uses`` names the SQL views its check builds on."""

    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            CHECKS[name] = check_sql(uses, sql.strip())
        return build

    return register
