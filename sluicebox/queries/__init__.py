"""Registered queries: every operator applied to whole driver tables, with the SQL that must give the same rows.

Messy text is derived from the tables by the same arithmetic on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluicebox.queries import checks, cleaning, files, geography, landing, lookups, published, resolution, timelines

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = (timelines, cleaning, files, geography, landing, lookups, resolution, checks, published)


def all_queries() -> dict[str, Query]:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.SQL.items()}
