"""Registered queries: Spark callables and their DuckDB oracle SQL.

Every callable takes ``(spark, sf_dir)``, reads the test tables under
``sf_dir`` (or frames Spark derives from them) and returns a DataFrame whose
column names equal the oracle's. Queries are registered by the modules that
define them through ``register``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: register ``fn`` under ``name`` with optional oracle SQL."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn
    return deco


def _load_all() -> None:
    # Importing the query modules fills the registry.
    from . import q_clean, q_html, q_sheets, q_stream, q_tables  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLE)
