"""All registered map queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hexfold.plans import elements, enrichment, networks, records, terrain, tiled
from hexfold.plans import queries as maps

MODULES = (maps, networks, records, terrain, elements, enrichment, tiled)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.oracle_sql().items()}
