"""Named queries over the provided tables, each beside the SQL that checks it.

A query module holds functions decorated with ``@query(name, sql)``; the name
"""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
MODULES: tuple[str, ...] = ("reads", "writes", "texts", "flows")

_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in _queries:
            raise ValueError(f"query {name} is registered twice")
        _queries[name] = function
        if sql is not None:
            _sql[name] = sql
        return function

    return register


def _load() -> None:
    for module in MODULES:
        import_module(f"tallyforge.plans.{module}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
