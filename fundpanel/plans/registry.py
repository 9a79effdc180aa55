"""All queries of the core operators: name -> (query, SQL over tables and views in braces, or None)."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from .adapters import duckdb

Query = Callable[[SparkSession, str], DataFrame]
MODULES = ("panel_queries", "core_queries", "indicator_queries", "report_queries", "structure_queries", "state_queries", "extract_queries")


def registered() -> dict[str, tuple[Query, str | None]]:
    out: dict[str, tuple[Query, str | None]] = {}
    for name in MODULES:
        out |= import_module(f"fundpanel.plans.{name}").QUERIES
    return out


def queries() -> dict[str, Query]:
    return {name: query for name, (query, _) in registered().items()}


def oracle_sql() -> dict[str, str]:
    return {name: duckdb(text) for name, (_, text) in registered().items() if text}
