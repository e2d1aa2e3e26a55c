"""Registry that pairs a Spark query with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rnd(value: Column | str, digits: int = 4) -> Column:
    """Round for comparison; adding 0.0 turns a negative zero into zero."""
    return F.round(F.col(value) if isinstance(value, str) else value, digits) + F.lit(0.0)


def n(expr: str | Column = "*") -> Column:
    return F.count(expr)
