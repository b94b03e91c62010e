"""All queries of the catalogue engine and their DuckDB twins."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MODULES = ["scalars", "relational", "books", "ingest"]


def modules() -> list:
    return [importlib.import_module(f"biblioforge.plans.{m}") for m in MODULES]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q for m in modules() for name, (q, _) in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in modules() for name, (_, sql) in m.QUERIES.items() if sql}
