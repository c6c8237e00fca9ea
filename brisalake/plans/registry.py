"""Named queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brisalake.plans.lake import Lake
from brisalake.plans.oracle import with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(lake)`` under ``name``."""
    def add(fn):
        if name in QUERIES:
            raise KeyError(f"{name} registered twice")
        QUERIES[name] = lambda spark, folder: fn(Lake(spark, folder))
        if sql is not None:
            ORACLES[name] = with_ctes(sql)
        return fn
    return add


def load() -> None:
    from brisalake.plans import (  # noqa: F401
        queries_aggregate, queries_analytics, queries_conform, queries_marts, queries_quality,
        queries_silver, queries_sources, queries_stream)
