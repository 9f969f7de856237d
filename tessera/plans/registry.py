"""Registry of named queries: a Spark builder ``(spark, sf_dir) -> DataFrame``
plus, where SQL can express the same result, an ANSI SQL text that DuckDB runs
on the same parquet tables (the correctness oracle)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .session import ship_package

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    note: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, note: str = ""):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)
        REGISTRY[name] = Query(name, build, sql.strip() if sql else None, note)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # importing the modules fills REGISTRY
    from . import (text_queries, relational_queries, graph_queries, sparse_queries,  # noqa: F401
                   stats_queries, sampling_queries, ml_queries, mlp_queries,
                   stream_queries)
    return REGISTRY
