"""Queries of the curation engine by id, and the SQL that each must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL where SQL can express it."""

    def put(f: Query) -> Query:
        _QUERIES[name] = f
        if oracle:
            _ORACLES[name] = oracle
        return f

    return put


def _load() -> None:
    from corpusflow.plans import catalogue  # noqa: F401  registers on import


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
