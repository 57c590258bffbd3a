"""Where the queries of the driver contract are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under `name`, with the SQL that must give the same rows."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def single(value: Column) -> Column:
    """A computed double to single precision: the engines add in different orders, and rounding to
    decimals would turn the last bit of a tie into a whole unit."""
    return value.cast("float").cast("double")


def single_sql(value: str) -> str:
    return f"cast(cast({value} AS float) AS double)"
