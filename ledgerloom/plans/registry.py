"""The table of registered queries and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.plans.oracle import with_views
from ledgerloom.plans.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None, views: str = ""):
    """Register a function of the adapter tables under a key.

    ``views`` names the adapter CTEs that the DuckDB text refers to.
    """

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[key] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLE[key] = with_views(sql.strip(), *views.split())
        return build

    return register
