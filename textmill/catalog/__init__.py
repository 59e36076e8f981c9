"""Registered queries over the driver's tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` together with its SQL twin."""

    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            TWINS[name] = sql
        return function

    return add


def load_all() -> None:
    """Import every module that registers queries."""
    from textmill.catalog import files, order, rows, scoring, splits, tokens, whole  # noqa: F401
