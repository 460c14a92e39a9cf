"""Registry of named queries: each has a Spark builder and (optionally) a DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    ids: str  # operator ids from the survey this query covers


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, ids: str = ""):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, ids)
        return fn

    return deco
