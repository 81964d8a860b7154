"""Every query of the library with the SQL that states its result."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}
MODULES = ("windows", "joins", "aggregates", "rules", "ranking", "statistics", "graph", "catalog", "expressions", "streams", "learn", "profiles", "monitoring", "offers", "validation", "debt", "stability")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and its SQL where there is one."""

    def add(run: Query) -> Query:
        assert name not in _queries, name
        _queries[name] = run
        if sql:
            _oracles[name] = sql
        return run

    return add


def _load() -> None:
    for module in MODULES:
        importlib.import_module(f"tallgrass.plans.{module}")


def queries() -> dict[str, Query]:
    _load()
    return _queries


def oracle_sql() -> dict[str, str]:
    _load()
    return _oracles


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["W1_rolling_window"](spark, sf_dir)
