"""Registered queries: each runs one operator family of the library over the whole
test tables and returns a DataFrame; ``SQL`` holds the DuckDB oracle for it.

Queries are grouped by module; each module contributes ``QUERIES`` and ``SQL``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


MODULES = ("q_stats", "q_clean", "q_profile", "q_split", "q_metrics", "q_transform",
           "q_regression", "q_glm", "q_series", "q_models", "q_sources")


def load_all() -> None:
    """Import every module that registers queries."""
    import importlib

    for m in MODULES:
        importlib.import_module(f"tabula.plans.{m}")
