"""Registry of named queries: Spark builder + optional DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ids: str = ""


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, ids: str = ""):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, ids)
        return fn
    return deco


def all_queries() -> dict[str, Query]:
    # import for registration side effects
    from civicstat.plans import (star_queries, longform_queries, reshape_queries,  # noqa: F401
                                 rank_queries, label_queries, quality_queries, profile_queries,
                                 gap_queries, scale_queries)
    return dict(REGISTRY)
