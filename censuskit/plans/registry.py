"""Collects the registered queries of all plan modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its inventory key, with DuckDB SQL where there is any."""

    def keep(fn: Query) -> Query:
        if key in _QUERIES:
            raise ValueError(f"query {key} is registered twice")
        _QUERIES[key] = fn
        if oracle is not None:
            _ORACLES[key] = oracle
        return fn

    return keep


def registered_sql() -> dict[str, str]:
    """The texts registered so far, for queries that are composed of others."""
    return dict(_ORACLES)


def _load() -> None:
    from censuskit.plans import modules

    modules.load()


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
