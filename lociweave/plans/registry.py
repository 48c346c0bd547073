"""Named queries of the library with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; sql: what gives the same rows in DuckDB over the same tables."""

    def put(f):
        _QUERIES[name] = f
        if sql:
            _SQL[name] = sql
        return f

    return put


def _load() -> None:
    from . import annotation, files, formats, fragments, graphs, hits, intervals, membership, more, order, records, rounds, sequences, sets, trees  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
