"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def register(name: str, run: Query, sql: str | None = None) -> Query:
    if name in _queries:
        raise ValueError(f"query {name} is registered twice")
    _queries[name] = run
    if sql is not None:
        _sql[name] = sql
    return run


def all_queries() -> dict[str, Query]:
    return dict(_queries)


def all_sql() -> dict[str, str]:
    return dict(_sql)
