"""Queries by name, and the same as SQL, from the modules of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import compare, grid, hist, stream, texts, trends, vector, zonal

MODULES = (zonal, trends, compare, hist, grid, vector, texts, stream)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: query for m in MODULES for k, (query, _) in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for m in MODULES for k, (_, sql) in m.QUERIES.items() if sql}
