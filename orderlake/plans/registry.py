"""Registered queries: name -> (builder(spark, sf_dir) -> DataFrame, oracle SQL or None).

Every builder reads the supplied tables (whole, no sampling) and runs the
library operators on what Spark derives from them. The oracle is DuckDB SQL
over the same tables with identical column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _load_all():
    # Importing the modules fills REGISTRY.
    from orderlake.plans import q_clustering, q_ledger, q_lifecycle, q_medallion, q_sources, q_state  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v[1] for k, v in REGISTRY.items() if v[1]}
