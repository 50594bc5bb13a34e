"""Registry of runnable queries: name -> (builder(spark, sf_dir), oracle SQL or None).

Each builder reads the driver tables (or data Spark derives from them), so its
work grows with the input.  The oracle SQL is the DuckDB twin used by the
correctness gate; ``None`` marks operators that SQL cannot express (ML fits).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def with_ctes(*parts: str) -> str:
    """``with_ctes(cte1, cte2, select)`` -> ``WITH cte1, cte2 select``."""
    *ctes, body = parts
    if not ctes:
        return body
    return "WITH " + ",\n".join(ctes) + "\n" + body
