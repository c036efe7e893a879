"""All queries of the core with their SQL.

A query is a function (spark, folder) -> DataFrame under ``@query(name, sql)``; the modules of this package
that hold some are listed in MODULES.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

MODULES = ("reports", "samples", "sequences", "texts", "world", "checks", "scoring", "parsing", "streams", "dialogs", "gates", "lookups")
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


def _load() -> None:
    for m in MODULES:
        importlib.import_module(f"railyard.plans.{m}")


def queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
