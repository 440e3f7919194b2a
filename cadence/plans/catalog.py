"""Query catalog: named queries over the driver tables, each with an optional DuckDB oracle.

A query is ``fn(spark, sf_dir) -> DataFrame``. The oracle SQL runs on views named after the
tables. Every computed column is aliased identically on both sides and doubles are rounded
to 6 digits, so results compare by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
OPERATORS: dict[str, str] = {}


def query(name: str, ids: str, sql: str | None = None):
    """Register ``fn`` under ``name``; ``ids`` lists the SURVEY operator ids it covers."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        OPERATORS[name] = ids
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


PLAN_MODULES = ("preparation", "profiling", "evaluation", "rollout", "promotion", "monitoring",
                "sources_plans", "training", "streams")


def load_all() -> None:
    """Import every plan module so its queries register."""
    import importlib
    for m in PLAN_MODULES:
        importlib.import_module(f"cadence.plans.{m}")
