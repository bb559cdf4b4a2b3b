"""Registry of driver queries: name -> (callable(spark, sf_dir) -> DataFrame, oracle SQL).

An oracle SQL string is given only where DuckDB can state the same result over the
same Parquet tables; queries without one (model fits, random samples, streams) are
checked on rows only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a driver query (and its DuckDB oracle, if any)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        fn.query_name = name
        return fn
    return deco
