"""Registry of named queries (Spark) and their oracle SQL (DuckDB)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Presentation rounding of float columns whose last bits depend on the
    summation order (the oracle rounds the same columns the same way)."""
    return df.withColumns({c: F.round(F.col(c), d) for c, d in digits.items()})
