"""Named queries: ``name -> (spark, sf_dir) -> DataFrame`` plus their oracle SQL.

Each query reads the test tables of ``sf_dir`` (or tables Spark derives from them)
in full; there is no row cap except where a limit is the feature (top-k, last-20
minutes, previews).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_SQL)


def _load_all() -> None:
    # Importing the modules registers their queries.
    from . import q_dashboard, q_features, q_governance, q_ml, q_quality, q_streaming, q_text  # noqa: F401


__all__ = ["register", "queries", "oracle_sql"]
