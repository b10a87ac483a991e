"""Query registry: name -> (function of Tables, SQL twin or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brightledger.sources.tables import Tables

_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return register


def _bound(fn):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(Tables(spark, folder))

    run.__doc__ = fn.__doc__
    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bound(fn) for name, fn in _QUERIES.items()}


def all_sql() -> dict[str, str]:
    return dict(_SQL)
