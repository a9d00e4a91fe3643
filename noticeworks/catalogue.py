"""All queries over the driver tables, with their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from noticeworks.plans import history, policy, records, scalars, silver, views

_MODULES = (history, policy, views, scalars, records, silver)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name to callable of (spark, sf_dir)."""
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """Name to DuckDB SQL with the same rows."""
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
